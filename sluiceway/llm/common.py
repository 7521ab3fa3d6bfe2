"""What several corpus operators share: text patterns, cut lineage, bounded broadcasts, ranks without one big task."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.session import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The folder that holds this package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Words in the sense of the benchmark check: letters and digits of ASCII, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in the sense of shingles and sizes: what stands between ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"
#: A table is broadcast only up to so many rows and bytes; beyond, the same join runs as a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20
#: So many copies of one row are put in their places by one task.
MANY_COPIES = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers on this machine also get the folder of this package on their path; on a cluster it
    has to be installed, or shipped with ``--py-files``."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, ROOT)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else (``lower`` would change letters beyond ASCII too)."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; the same in other SQL engines. Null has a key of its own."""
    return F.coalesce(F.md5(text), F.lit("-"))


def packed(df: DataFrame) -> DataFrame:
    """All columns as one, ``row``: names that a table brings along cannot clash with an operator's own."""
    return df.select(F.struct(*(F.col(f"`{c}`").alias(c) for c in df.columns)).alias("row"))


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there, and a lost executor costs nothing."""
    path = fresh_path(df.sparkSession, label)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def drop_cut(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` has written, once all that was made of them is written itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def hash_filter(hashes: DataFrame, bits: int) -> Broadcast:
    """A bit for each of ``2 ** bits`` buckets of the 64-bit column ``h``, set where one falls, for ``may_hold``.

    Its size does not depend on the number of hashes; more of them only let more pass.
    """
    bucket = F.shiftrightunsigned("h", 64 - bits)
    words = hashes.select(bucket.alias("bucket")).groupBy(F.shiftright("bucket", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bucket & 63 AS INT))")).alias("bits"))
    out = np.zeros(1 << (bits - 6), "uint64")
    for batch in words.toArrow().to_batches():
        out[batch.column("at").to_numpy()] = batch.column("bits").to_numpy().astype("uint64")
    return hashes.sparkSession.sparkContext.broadcast(out)


def may_hold(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """False only for hashes that are not in the filter."""
    bucket = h.view("uint64") >> np.uint64(59 - len(known).bit_length())
    return (known[(bucket >> np.uint64(6)).astype("int64")] >> (bucket & np.uint64(63))) & np.uint64(1) == 1


def _bytes(name: str, kind: T.DataType) -> Column:
    """About what a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 8
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(name)), F.lit(0)) + 8
    return F.lit(8)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a table that has already been cut for broadcast if its rows and bytes are few enough; else leave the join to Spark."""
    width = sum((_bytes(f"`{f.name}`", f.dataType) for f in df.schema), F.lit(16))
    count, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if count <= rows and total <= size else df


def fold_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that are equal in all ``keys`` become one row with their number in ``copies``.

    Equal rows cannot be told apart by any key, so this is what keeps a row that makes up a third of a table from
    ending in one task. Counts are combined before the shuffle.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def unfold_rows(df: DataFrame) -> DataFrame:
    """The opposite of ``fold_rows``: each row ``copies`` times, with the number of the copy from 0 in ``copy``."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))


def place_rows(rows: DataFrame, keys: Sequence[str], plan: DataFrame) -> DataFrame:
    """``row`` and the columns of ``plan`` (``keys``, ``copy``, ``copies`` and more; already cut) that are meant for it.

    ``rows`` has ``keys``, all of them taken from ``row``; the plan has one row per row of it. Rows that are equal in
    ``keys`` are numbered from 0 by a hash of the whole row, and get the plan's ``copy`` of that number.

    Rows are moved once at most: where keys repeat, rows that are equal as a whole are folded before they are moved, and meet their
    places, which are worked out from hashes alone, where they then are. A row of more than ``MANY_COPIES`` goes to several tasks.
    """
    def same(other: dict[str, Column]) -> Column:
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(other[k])
        return on

    planned = plan.select(F.struct(*plan.columns).alias("plan"))
    at = same({k: F.col("plan")[k] for k in keys}) & (F.col("copy") == F.col("plan.copy"))
    repeated = plan.filter("copies > 1 AND copy = 0")
    if repeated.isEmpty():
        return rows.select(*keys, "row", F.lit(0).cast("long").alias("copy")).join(planned, at).select("row", "plan.*")

    hashed = rows.select(*keys, "row", F.md5(F.to_json("row")).alias("row_id"))
    counts = cut(hashed.groupBy(*keys, "row_id").agg(F.count(F.lit(1)).alias("copies")), "numbered-rows")
    more = bounded(cut(repeated.select(*(F.col(k).alias(f"more_{k}") for k in keys), F.col("copies").alias("more")), "repeated-rows"))
    marked = counts.join(more, same({k: F.col(f"more_{k}") for k in keys}), "left")
    several = marked.filter("more IS NOT NULL").withColumns(
        {"key": hash_fraction(F.col("row_id")), "weight": F.col("copies"), "slices": F.ceil(F.sqrt("more"))})
    numbered = prefix_sums(several, keys, "key", ["row_id"], "weight", "slices").select(*keys, "row_id", "copies", "before").unionByName(
        marked.filter("more IS NULL").select(*keys, "row_id", "copies", F.lit(0).cast("long").alias("before")))
    # One column, never null, that says the same as keys and row_id: what is grouped by it needs no further move to be joined by it.
    place = F.md5(F.concat_ws(":", F.xxhash64(*keys).cast("string"), "row_id"))
    each = unfold_rows(numbered.withColumn("many", F.col("copies") > MANY_COPIES)).withColumns(
        {"place": place, "part": F.expr(f"copy DIV {MANY_COPIES}"), "copy": F.col("before") + F.col("copy")})
    places = each.select(*keys, "copy", "place", "part", "many").join(planned, at).select("place", "part", "many", "plan")

    once = hashed.select(place.alias("place"), "row").groupBy("place").agg(F.any_value("row").alias("row"))
    out = once.join(places.filter("NOT many").select("place", "plan"), "place").select("row", "plan.*")
    many = counts.filter(F.col("copies") > MANY_COPIES).select(place.alias("m_place"), F.expr(f"(copies - 1) DIV {MANY_COPIES}").alias("last"))
    if many.isEmpty():
        return out
    few = hashed.withColumn("place", place).join(bounded(cut(many, "many-rows")), F.col("place") == F.col("m_place")).groupBy("place", "last").agg(
        F.any_value("row").alias("row")).select("place", "row", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("part"))
    return out.unionByName(few.join(places.filter("many").select("place", "part", "plan"), ["place", "part"]).select("row", "plan.*"))


def hash_fraction(*parts: Column) -> Column:
    """A repeatable random number of 60 bits out of the parts (null and empty text differ)."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


#: ``hash_fraction`` is below this.
FRACTION_END = 1 << 60


def prefix_sums(df: DataFrame, group: Sequence[str], key: str, ties: Sequence[str], weight: str,
                slices: str) -> DataFrame:
    """Adds ``before``: the sum of ``weight`` over the rows of the same group that come earlier by ``key``.

    The key is uniform below ``FRACTION_END``, so cutting its range evenly gives ``slices`` (a column, constant in a
    group) near-equal slices. Slices are summed, their sums are added up within the group, and rows are added up
    within their slice. With about the square root of a group's rows as ``slices``, neither window sees more
    than that many rows, however large the group is. Equal groups that are null belong together.
    """
    sliced = df.withColumn("slice", F.floor(F.col(key) / F.lit(float(FRACTION_END)) * F.col(slices)).cast("long"))
    totals = sliced.groupBy(*group, "slice").agg(F.sum(weight).alias("slice_weight"))
    so_far = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*(F.col(g).alias(f"o_{g}") for g in group), F.col("slice").alias("o_slice"),
                            F.coalesce(F.sum("slice_weight").over(so_far), F.lit(0)).alias("offset"))
    on = F.col("slice") == F.col("o_slice")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"o_{g}"))
    inside = Window.partitionBy(*group, "slice").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return sliced.join(offsets, on).withColumn(
        "before", F.col("offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0))).drop(
        "slice", "o_slice", "offset", *(f"o_{g}" for g in group))
