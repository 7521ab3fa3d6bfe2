"""Filter interaction audit: what each filter removes in each order, and what it would have removed on its own."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import TOKEN, UPPER, cut

#: What a cell of the fold holds, each a count of documents.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def word_counts(text: Column) -> Column:
    """(n, different): the words of a text, what stands between ASCII white space, and how many of them differ."""
    words = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    # Through a one-element list, so that Spark works the words out once and not at each use.
    return F.transform(F.array(words), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("different")))[0]


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """The filters that look at one text: true where it fails. A, B, C and D of the audit; E needs the whole table."""
    length = F.length(text).cast("long")
    capitals = length - F.length(F.translate(text, UPPER, ""))
    return {"A": words["n"] < 200, "B": words["different"] * 100 < words["n"] * 50, "C": capitals * 100 > length * 2,
            "D": text.rlike("[#$%&*|]")}


def _bits(failing: Mapping[str, Column], letters: str) -> Column:
    return sum((F.when(failing[f], F.lit(1 << letters.index(f))).otherwise(F.lit(0)) for f in failing), F.lit(0)).cast("int")


def mask_cells(docs: DataFrame, labels: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """(part, mask, good, toxic, weight): how many documents of a part fail the same filters and bear the same labels.

    The last letter stands for the duplicate filter: a document fails it where its text equals that of a smaller doc_id,
    wherever in the table. Texts are named by two digests (192 bits) and their length. Documents are folded to (text,
    doc_id, part) before anything is compared, and to (text, part, labels) before the smallest doc_id of a text is looked
    for, so a text that fills a third of the table is a few rows by then, and no text is moved at all.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    single = text_filters(F.col("t"), F.col("words"))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("t"))
    seen = read.withColumn("words", word_counts(F.col("t"))).select("doc_id", "part", F.struct(F.md5("t").alias("md5"), F.xxhash64("t").alias("hash"), F.octet_length("t").alias("bytes")).alias("is"),
                       _bits(single, letters).alias("mask"))
    folded = seen.groupBy("is", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("rows"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marked = folded.join(marks, F.col("doc_id") == F.col("label_id"), "left").select(
        "is", "doc_id", "part", "mask", "rows", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # Of each kind of document the rows that bear its smallest doc_id (one folded row), and those without a doc_id.
    kinds = cut(marked.groupBy("is", "part", "mask", "good", "toxic").agg(
        F.sum("rows").alias("rows"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows"))).alias("first"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("rows"))), F.lit(0)).alias("nameless")), "audit-kinds")
    earliest = kinds.groupBy(F.col("is").alias("text_is")).agg(F.min("first.doc_id").alias("earliest"))
    placed = kinds.join(earliest, F.col("is") == F.col("text_is"))
    spared = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("earliest"), F.col("first.rows")).otherwise(F.lit(0))
    both = F.array(F.struct(F.col("mask").alias("mask"), spared.alias("weight")),
                   F.struct((F.col("mask") + (1 << (len(letters) - 1))).alias("mask"), (F.col("rows") - spared).alias("weight")))
    split = placed.select("part", "good", "toxic", F.inline(both))
    return split.groupBy("part", "mask", "good", "toxic").agg(F.sum("weight").alias("weight"))


def _fold_sql(letters: str) -> str:
    """All orders folded over one cell: a list of structs, one per order and step.

    Each order in ``orders`` is walked by an aggregate whose state says whether the cell's documents are still there.
    """
    def count(when: str) -> str:
        return f"CASE WHEN {when} THEN weight ELSE 0L END"

    bit = f"shiftleft(1, instr('{letters}', substr(o, k, 1)) - 1)"
    fails, alive = f"(mask & {bit}) <> 0", "s.alive"
    row = f"""named_struct('step', k, 'filter', substr(o, k, 1), 'kept', {count(f"{alive} AND NOT {fails}")},
        'removed', {count(f"{alive} AND {fails}")}, 'redundant', {count(f"NOT {alive} AND {fails}")}, 'unique_fails', {count(f"mask = {bit}")},
        'good_lost', {count(f"{alive} AND {fails} AND good")}, 'toxic_lost', {count(f"{alive} AND {fails} AND toxic")})"""
    kind = "array<struct<step:int,filter:string," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    walk = f"""aggregate(sequence(1, {len(letters)}), named_struct('alive', true, 'done', CAST(array() AS {kind})),
        (s, k) -> named_struct('alive', {alive} AND NOT ({fails}), 'done', concat(s.done, array({row}))), s -> s.done)"""
    return f"flatten(transform(orders, o -> transform({walk}, r -> named_struct('filter_order', o, 'at', r))))"


def audit(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, from ``mask_cells``.

    A cell is folded over the array of all orders, a literal that travels with the plan (120 texts for five filters, known
    beforehand); its structs are added up element by element over the cells of a part, combined before the shuffle. How
    many rows there are depends on the number of parts alone. ``shapley`` is what a filter removes, summed over all orders.
    """
    orders = F.array(*(F.lit("".join(o)) for o in permutations(letters)))
    each = cells.withColumn("orders", orders).select("part", F.explode(F.expr(_fold_sql(letters))).alias("x")).select("part", "x.filter_order", "x.at.*")
    merged = each.groupBy("part", "filter_order", "step", "filter").agg(*(F.sum(c).alias(c) for c in COUNTS))
    all_orders = Window.partitionBy("part", "filter")
    return merged.withColumn("shapley", F.sum("removed").over(all_orders)).select("part", "filter_order", "step", *COUNTS, "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters A to E over ``docs`` (doc_id, text, source) with ``labels`` (doc_id, quality, toxic).

    Null text is empty; null source is the empty part; a document without a doc_id has no smaller one and is none, so it
    never fails E and makes none fail it. Rows of one doc_id and text are all the earliest or none. Of several labels of
    a document, one that says 1 is enough. Other columns are ignored. An empty table gives no rows.
    """
    return audit(mask_cells(docs, labels))
