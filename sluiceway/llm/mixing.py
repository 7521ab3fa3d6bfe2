"""Mixing sources to target weights: hash-random order, distributed prefix sums, a cut at each source's exact budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import (
    TOKEN, bounded, cut, fold_rows, hash_fraction, packed, place_rows, prefix_sums, text_key, unfold_rows,
)


def count_tokens(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, take the weights in turn. Together they get ``share`` times all words; none
    gets more than ``most`` times its own, and what is cut off goes to the others by weight. Sharing out again and
    again ends where one level serves all: with sources ordered by the level at which they are full, the first one
    that is not full at the level left for it and all after it fixes that level. Both windows have one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    sized = sources.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    levels = sized.select(
        "source", "source_size", "rows", "weight", "cap",
        F.row_number().over(order).alias("place"),
        ((F.lit(float(share)) * F.sum("source_size").over(whole)
          - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))).alias("level"))
    open_place = F.min(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("place"))).over(whole)
    fixed = levels.withColumn("open", open_place).withColumn(
        "level", F.max(F.when(F.col("place") == F.col("open"), F.col("level"))).over(whole))
    return fixed.select("source", "source_size", "rows", F.when(
        F.col("open").isNull() | (F.col("place") < F.col("open")), F.col("cap")
    ).otherwise(F.col("weight") * F.col("level")).alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
             seed: int = 0, numbered: bool = False) -> DataFrame:
    """How many words the mix takes of each document: doc_id, text_id, size, source, source_size, target, taken.

    ``docs`` needs doc_id, source and text; other columns are ignored. One row per row of ``docs``.

    * Each source's documents are put in a random order that a hash fixes (the same in each run). Budgets that hold a
      source several times take whole passes over it first; the rest of the budget is cut from the front of the
      order, to the word. ``taken`` counts repeats. A source's words add up to its target, rounded down.
    * Null and empty text: size 0, nothing taken. Null source: a source of its own. Null doc_id: allowed.
    * Equal rows: each counts; they lie side by side in the order. No source, an empty table: no rows.
      ``numbered`` adds their number from 0, ``copy``, and how many they are, ``copies``.
    """
    plain = docs.select("doc_id", "source", count_tokens(F.col("text")).alias("size"), text_key(F.col("text")).alias("text_id"))
    folded = cut(fold_rows(plain, ["doc_id", "source", "size", "text_id"]), "mix-documents")
    sources = cut(folded.groupBy("source").agg(F.sum("copies").alias("rows"),
                                               F.sum(F.col("copies") * F.col("size")).alias("source_size")), "mix-sources")
    targets = cut(source_targets(sources, weights, share, most), "mix-targets").withColumnRenamed("source", "t_source")
    keyed = folded.join(bounded(targets), F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source").withColumns({
        "key": hash_fraction(F.lit(seed), F.col("doc_id"), F.col("text_id")),
        "weight": F.col("copies") * F.col("size"),
        "slices": F.ceil(F.sqrt("rows")),
    })
    ranked = prefix_sums(keyed, ["source"], "key", ["doc_id", "text_id"], "weight", "slices")
    budget = F.floor(F.col("target")).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    start = F.col("before") + F.col("copy") * F.col("size")
    rest = budget - passes * F.col("source_size")
    return unfold_rows(ranked).select(
        "doc_id", "text_id", "size", "source", "source_size", "target",
        (F.col("size") * passes + F.least(F.greatest(rest - start, F.lit(0)), F.col("size"))).cast("long").alias("taken"),
        *(["copy", "copies"] if numbered else []))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, repeated or left out as ``mix_plan`` says.

    A document of which 2.5 times its size is taken comes out three times, the third time only up to the word where the
    budget ends, with single spaces between words. Documents of which nothing is taken go, so those without words do. All
    columns are kept; where n_chars is one of them, it follows a text that was cut. Rows equal in doc_id, source and
    text get what the plan takes of each, in the order of a hash of the whole row.
    """
    shares = cut(mix_plan(docs, **settings, numbered=True), "mix-plan")
    keys = ["doc_id", "source", "text_id"]
    rows = packed(docs).select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
                               text_key(F.col("row.text")).alias("text_id"), "row")
    placed = place_rows(rows, keys, shares.select(*keys, "size", "taken", "copy", "copies")).filter("taken > 0")
    passes = F.ceil(F.col("taken") / F.col("size"))
    taken = placed.select("row", "taken", "size", F.explode(F.sequence(F.lit(1).cast("long"), passes)).alias("pass"))
    left = F.col("taken") - (F.col("pass") - 1) * F.col("size")
    short = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(TOKEN), F.lit(0)), F.lit(1), left.cast("int")), " ")
    text = F.when(left < F.col("size"), short).otherwise(F.col("row.text"))
    out = {c: F.col("row")[c] for c in docs.columns} | {"text": text}
    if "n_chars" in out:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(left < F.col("size"), F.length(short).cast(kind)).otherwise(F.col("row.n_chars"))
    return taken.select(*(column.alias(name) for name, column in out.items()))
