"""N-gram Jaccard join by grouped prefixes: which documents are so alike in their shingles that they are one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import TOKEN, ascii_lower, bounded, cut, drop_cut, packed, text_key
from sluiceway.llm.components import connected_components


@dataclass(frozen=True)
class Join:
    """Shingles of ``n`` words; documents link from ``percent`` / 100 of Jaccard similarity.

    ``spare`` is how many more tokens than needed a prefix is made of, as a share of those needed, so that rare ones can
    be chosen; a prefix of up to ``short`` tokens is taken in any case. Buckets of at most ``pairs`` members are compared pair by pair, larger ones in blocks of ``block``. Both
    ways are exact. ``rounds`` of comparing with one neighbour each come first.
    """

    n: int = 4
    percent: int = 85
    spare: float = 0.5
    short: int = 64
    rounds: int = 2
    pairs: int = 48
    block: int = 256


def shingles(text: Column, n: int) -> Column:
    """The set of a text: sorted distinct 64-bit hashes of its runs of ``n`` words, or of all its words if they are fewer.

    Words stand between ASCII white space; A-Z are taken in lower case. Null and texts without words have an empty set.
    """
    words = F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))
    codes = F.transform(words, lambda w: F.xxhash64(w))

    def of(codes: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(codes) - n), lambda i: F.xxhash64(F.lit(n), *(F.get(codes, i + k) for k in range(n))))
        return F.when(F.size(codes) >= n, runs).when(F.size(codes) > 0, F.array(F.xxhash64(F.size(codes), codes))).otherwise(
            F.array().cast("array<bigint>"))

    # Through a one-element list, so that Spark works the codes out once and not at each use.
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.array(codes), of))))


def with_shingles(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, text_id, the size of its set, the set, and two hashes that together stand for it."""
    sets = docs.select("doc_id", text_key(F.col("text")).alias("text_id"), shingles(F.col("text"), join.n).alias("set"))
    return sets.select("doc_id", "text_id", F.size("set").cast("long").alias("size"), F.xxhash64("set").alias("k1"),
                       F.xxhash64(F.lit(1), "set").alias("k2"), "set")


def _needed(size: Column, join: Join) -> Column:
    """Of so many shingles of a document, whichever they are, a similar document has at least one.

    A similar document has at least ``percent`` of the shingles, rounded up, so it lacks at most the rest.
    """
    return size - F.floor((size * join.percent + 99) / 100).cast("long") + 1


def _prefix_size(size: Column, join: Join) -> Column:
    wanted = F.greatest(F.lit(join.short), F.ceil(_needed(size, join) * (1 + join.spare)) + 1)
    return F.greatest(F.lit(1), F.least(size, wanted)).cast("int")


def _alike(a: str, b: str, join: Join) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * join.percent


def _band(size: Column, join: Join) -> Column:
    """Sizes that a link can have differ by at most one band. (A hair more than the ratio, against rounding.)"""
    return F.floor(F.log(size.cast("double")) / float(np.log(100.0 / join.percent) * 1.0000001)).cast("int")


def _verified(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Those of the pairs (a, b) that link, by their whole sets."""
    first = sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a"))
    second = sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    counted = both.select("a", "b", shared.alias("shared"), (F.size("set_a") + F.size("set_b")).alias("sizes"))
    return counted.filter(F.col("shared") * 100 >= (F.col("sizes") - F.col("shared")) * join.percent).select("a", "b")


def _block_links(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Compare two blocks of documents: shared shingles by products of 0/1 matrices, some columns at a time."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, side = group["cls"].to_numpy(), group["side"].to_numpy()
        sets = [np.asarray(s, dtype="int64") for s in group["set"]]
        sizes = np.array([len(s) for s in sets])
        values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        keep = times[column] > 1
        row, column = row[keep], column[keep]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        first, second = (np.flatnonzero(side & bit) for bit in (1, 2))
        shared = np.zeros((len(first), len(second)), dtype="float32")
        starts = np.searchsorted(column, np.arange(0, len(values) + 4096, 4096))
        for a, b in zip(starts, starts[1:]):
            if b > a:
                part = np.zeros((len(sets), 4096), dtype="float32")
                part[row[a:b], column[a:b] % 4096] = 1
                shared += part[first] @ part[second].T
        union = sizes[first][:, None] + sizes[second][None, :] - shared
        x, y = np.nonzero(shared * 100 >= union * percent)
        a, b = first[x], second[y]
        low = ids.copy()
        while len(a):
            was = low.copy()
            np.minimum.at(low, a, low[b])
            np.minimum.at(low, b, low[a])
            if (was == low).all():
                break
        linked = low < ids
        return pd.DataFrame({"a": ids[linked], "b": low[linked]})

    return run


def _in_blocks(buckets: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Links among the members of large buckets (token, band, cls). Buckets that share members are compared as one."""
    first = buckets.groupBy("token", "band").agg(F.min("cls").alias("first"))
    to_first = buckets.join(first, ["token", "band"]).select(F.col("cls").alias("a"), F.col("first").alias("b"))
    whole = connected_components(to_first, "join-clusters").select(F.col("node").alias("cls"), F.col("component").alias("cluster"))
    counted = whole.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / join.block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("cls", "cluster"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j"),
        F.when(j == F.col("mine"), 3).when(F.col("mine") < j, 1).otherwise(2).alias("side")))
    dealt = whole.join(counted, "cluster").withColumn("mine", mine).withColumn("meet", F.explode(meets)).select(
        "cluster", "cls", "meet.i", "meet.j", "meet.side")
    return dealt.join(sets, "cls").groupBy("cluster", "i", "j").applyInPandas(_block_links(join.percent), "a long, b long")


def jaccard_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others are ignored): doc_id, text_id, n_shingles, component_id.

    1. Documents with equal sets are one class.
    2. A prefix is the smallest hashes of a set, some more than a similar document could all lack. Classes with equal
       prefix and size are a group, which the first steps treat as one.
    3. Of each prefix the rarest tokens are chosen, as many as a similar document cannot all lack. Two similar documents
       so share a token that one of them has chosen and the other has in its prefix; tokens that nobody shares are
       dropped. Who shares a token, at near sizes, is a bucket.
    4. Each document that chose tokens is compared with one neighbour, links are joined to components, and buckets whose
       members are all in one component are done: large families of copies do not need all their pairs.
    5. In what is left, all members that stand in different components are compared by their whole sets: pair by pair
       in small buckets, block by block in large ones.

    No pair is lost: steps 2 and 3 hold for each similar pair whatever is chosen, and step 5 leaves out none that could
    join two components. Null doc_id: the row has its class's component (null if no other row of the class has an id). Null
    or wordless text: size 0, component is doc_id. Repeated rows: each its row, the same result. Texts that share a doc_id
    link each on its own.
    """
    prefix = F.slice("set", 1, _prefix_size(F.col("size"), join))
    known = cut(with_shingles(docs, join).withColumn("prefix", prefix).withColumn("g", F.xxhash64("prefix", "size")).drop("set"), "join-documents")
    # From here to the tokens only ids and hashes are moved; prefixes are long.
    classes = known.filter("size > 0").groupBy("size", "k1", "k2").agg(F.min("doc_id").cast("long").alias("first_id"), F.min("g").alias("g"))
    # Named by a number of their own: one doc_id may stand for several texts. The table is written, so the numbers stay.
    classes = cut(classes.filter("first_id IS NOT NULL").withColumn("cls", F.monotonically_increasing_id()), "join-classes")
    leaders = classes.groupBy("g", "size").agg(F.min("cls").alias("group"), F.count(F.lit(1)).alias("members"))
    grouped = cut(classes.join(leaders, ["g", "size"]).select("cls", "first_id", "size", "k1", "k2", "group", "members"), "join-groups")
    drop_cut(classes)
    inside = grouped.filter("members > 1")

    row = ["doc_id", "k1", "k2"]
    leading = known.join(grouped.filter("cls = group").select("group", "first_id", "k1", "k2"), ["k1", "k2"]).filter(
        "doc_id = first_id").select(*row, "group", "prefix")
    again = cut(known.groupBy(*row).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(*row), "join-repeated")
    once = leading.join(bounded(again), row, "left_anti").unionByName(leading.join(bounded(again), row, "left_semi").dropDuplicates(row))
    tokens = once.select("group", F.explode_outer("prefix").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select(F.col("token").alias("t"), "df")
    shared = cut(tokens.join(often, F.col("token") == F.col("t")).drop("t"), "join-tokens")
    sized = shared.join(grouped.filter("cls = group").select("group", "size"), "group")
    per_group = Window.partitionBy("group")
    ranked = sized.withColumns({"rank": F.row_number().over(per_group.orderBy("df", "token")),
                                "lonely": _prefix_size(F.col("size"), join) - F.count(F.lit(1)).over(per_group)})
    chosen = F.col("rank") <= _needed(F.col("size"), join) - F.col("lonely")
    band = _band(F.col("size"), join)
    entries = cut(ranked.select("group", "size", "token", chosen.alias("chosen"), F.explode(F.array(
        F.struct(band.alias("band"), F.lit(True).alias("home")), F.struct((band + 1).alias("band"), F.lit(False).alias("home")))).alias("at")).select(
        "group", "size", "token", "chosen", "at.band", "at.home"), "join-entries")
    useful = entries.groupBy("token", "band").agg(F.count(F.lit(1)).alias("rows"), F.max("chosen").alias("c"), F.max("home").alias("h")).filter(
        "rows > 1 AND c AND h").select("token", "band")
    buckets = cut(entries.join(useful, ["token", "band"]), "join-buckets")
    drop_cut(shared, entries, again)

    # The whole sets of those that may be compared; worked out again from their texts rather than kept for all. They are
    # written before they are tested: Spark would take the test for a join key, and work the sets out for all documents.
    wanted = buckets.select(F.col("group").alias("cls")).union(inside.select("cls")).distinct()
    wanted = cut(wanted.join(grouped.select("cls", "first_id", F.col("k1").alias("w1"), F.col("k2").alias("w2")), "cls"), "join-wanted")
    texts = docs.select("doc_id", "text").join(bounded(wanted), F.col("doc_id") == F.col("first_id"))
    sets = cut(texts.select("cls", "w1", "w2", shingles(F.col("text"), join.n).alias("set")), "join-sets").filter(
        (F.xxhash64("set") == F.col("w1")) & (F.xxhash64(F.lit(1), "set") == F.col("w2"))).select("cls", "set")
    if not sets.groupBy("cls").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").isEmpty():
        sets = cut(sets.dropDuplicates(["cls"]), "join-sets")  # rows of equal doc_id and set

    of_bucket = buckets.withColumnRenamed("group", "cls")
    to_try = inside.filter("cls <> group").select(F.col("cls").alias("a"), F.col("group").alias("b"))
    links = component = None
    for _ in range(join.rounds):
        now = of_bucket.withColumn("component", F.col("cls")) if component is None else _with_component(of_bucket, component)
        ends = now.groupBy("token", "band").agg(F.min(F.struct("component", "cls")).alias("low"), F.max(F.struct("component", "cls")).alias("high"))
        open_ = ends.filter("low.component <> high.component")
        other = F.when(F.col("low.component") != F.col("component"), F.col("low.cls")).otherwise(F.col("high.cls"))
        asked = now.filter("chosen").join(open_, ["token", "band"]).select("cls", other.alias("other"))
        most = asked.groupBy("cls", "other").agg(F.count(F.lit(1)).alias("times")).groupBy("cls").agg(F.max_by("other", "times").alias("other"))
        pairs = most.select(F.col("cls").alias("a"), F.col("other").alias("b"))
        tried = _verified(pairs if links is not None else pairs.unionByName(to_try), sets, join)
        links = cut(tried if links is None else links.unionByName(tried), "join-links")
        component = connected_components(links, "join-components")

    # All members now, not groups: those of a group share its entries, and are a bucket of their own.
    members = grouped.select("cls", "group", F.col("size").alias("own_size"))
    spread = buckets.join(members, "group").select("token", "band", "cls", "size", "chosen", "home").unionByName(inside.select(
        F.col("group").alias("token"), F.lit(-1).alias("band"), "cls", "size", F.lit(True).alias("chosen"), F.lit(True).alias("home")))
    last = _with_component(spread, component)
    open_ = last.groupBy("token", "band").agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("low"), F.max("component").alias("high")).filter(
        "low <> high").select("token", "band", "rows")
    left = cut(last.join(open_, ["token", "band"]), "join-left")
    small = left.filter(F.col("rows") <= join.pairs)
    x, y = (small.select("token", "band", *(F.col(c).alias(f"{c}_{s}") for c in ("cls", "size", "chosen", "home", "component"))) for s in "ab")
    pairs = x.join(y, ["token", "band"]).filter((F.col("cls_a") < F.col("cls_b")) & (F.col("component_a") != F.col("component_b"))
                                                & (F.col("chosen_a") | F.col("chosen_b")) & (F.col("home_a") | F.col("home_b"))
                                                & _alike("size_a", "size_b", join))
    by_pair = _verified(pairs.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct(), sets, join)
    by_block = _in_blocks(cut(left.filter(F.col("rows") > join.pairs).select("token", "band", "cls"), "join-large"), sets, join)
    component = connected_components(cut(links.unionByName(by_pair).unionByName(by_block), "join-links"), "join-components")

    smallest = component.join(grouped.select("cls", "first_id"), F.col("node") == F.col("cls")).groupBy("component").agg(F.min("first_id").alias("least"))
    least = component.join(smallest, "component").select("node", "least")
    of_class = grouped.join(least, F.col("cls") == F.col("node"), "left").select(
        F.struct("size", "k1", "k2").alias("is"), F.coalesce("least", "first_id").alias("component"))
    named = known.join(of_class, F.struct("size", "k1", "k2") == F.col("is"), "left")
    own = F.when(F.col("size") == 0, F.col("doc_id").cast("long")).otherwise(F.col("component"))
    return named.select("doc_id", "text_id", F.col("size").alias("n_shingles"), own.alias("component_id"))


def _with_component(rows: DataFrame, component: DataFrame) -> DataFrame:
    """Adds the component of ``cls``; one without links is its own."""
    found = component.select(F.col("node").alias("cls"), F.col("component").alias("found"))
    return rows.join(found, "cls", "left").withColumn("component", F.coalesce("found", "cls")).drop("found")


def one_per_component(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``docs`` with one row of each component, the one that names it; its columns and those rows unchanged.

    Of rows with equal doc_id and text one stays; other texts under the naming doc_id stay too. Rows without doc_id stay where no row with one has their shingles.
    """
    found = jaccard_components(docs, join)
    names = found.filter("doc_id = component_id OR (doc_id IS NULL AND component_id IS NULL)")
    keep = names.select(F.struct("doc_id", "text_id").alias("keep")).distinct()
    rows = packed(docs).withColumns({"id": F.col("row.doc_id"), "text_id": text_key(F.col("row.text"))})
    here = F.col("id").eqNullSafe(F.col("keep.doc_id")) & (F.col("text_id") == F.col("keep.text_id"))
    return rows.join(keep, here, "left_semi").dropDuplicates(["id", "text_id"]).select("row.*")
