"""Reconciliation of input against written tables, backlog, commit log and duplicate keys."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _checksums(source: DataFrame, main: DataFrame, dlq: DataFrame, key: str, ranges: int) -> DataFrame:
    """Per range of key hashes: how many rows each side has, and two sums over their keys that do not depend on the order."""
    def side(df: DataFrame, name: str) -> DataFrame:
        first = F.xxhash64(key)
        return df.select(F.pmod(first, F.lit(ranges)).alias("range"), F.lit(name).alias("side"), first.cast("decimal(38,0)").alias("h1"),
                         F.xxhash64(F.lit(1), key).cast("decimal(38,0)").alias("h2"))

    rows = side(source, "i").unionByName(side(main, "m")).unionByName(side(dlq, "d"))

    def total(value: Column, *names: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side").isin(*names), value)), F.lit(0))

    one = F.lit(1).cast("bigint")
    return rows.groupBy("range").agg(
        *[total(one, n).alias(n) for n in "imd"],
        *[total(F.col(h), "i").alias(f"{h}_in") for h in ("h1", "h2")], *[total(F.col(h), "m", "d").alias(f"{h}_out") for h in ("h1", "h2")])


def write_contract(source: DataFrame, main: DataFrame, dlq: DataFrame, key: str = "event_id", ranges: int = 4096) -> DataFrame:
    """One row telling whether every input record was written exactly once, to either table.

    Both sides are first summed up by ``ranges`` ranges of key hashes: counts and order-free checksums, combined before the
    shuffle, so that no key is moved. Only keys of ranges that differ are then counted one by one; of tables that agree
    there are none. (Two sums of 64-bit hashes and the counts would all have to agree by accident for a difference to be missed.)
    """
    sums = _checksums(source, main, dlq, key, ranges)
    same = (F.col("i") == F.col("m") + F.col("d")) & (F.col("h1_in") == F.col("h1_out")) & (F.col("h2_in") == F.col("h2_out"))
    differ = sums.where(~same).select("range")  # at most ``ranges`` rows

    def counted(df: DataFrame, *ones: int) -> DataFrame:
        doubtful = df.select(key, F.pmod(F.xxhash64(key), F.lit(ranges)).alias("range")).join(F.broadcast(differ), "range", "left_semi")
        return doubtful.select(key, *[F.lit(n).alias(c) for c, n in zip("iw", ones, strict=True)])

    sides = counted(source, 1, 0).unionByName(counted(main, 0, 1)).unionByName(counted(dlq, 0, 1))
    per_key = sides.groupBy(key).agg(F.sum("i").alias("i"), F.sum("w").alias("written"))
    read, written = F.col("i"), F.col("written")
    wrong = per_key.agg(F.struct(
        F.coalesce(F.sum(F.greatest(read - written, F.lit(0))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(read > 0, F.greatest(written - read, F.lit(0)))), F.lit(0)).alias("duplicated"),
        F.coalesce(F.sum(F.when(read == 0, written)), F.lit(0)).alias("unexpected")).alias("wrong"))
    counts = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("i", "input_records"), ("m", "main_records"), ("d", "dlq_records"))])
    both = counts.withColumn("wrong", wrong.scalar()).select("input_records", "main_records", "dlq_records", "wrong.*")
    kept = (F.col("missing") == 0) & (F.col("duplicated") == 0) & (F.col("unexpected") == 0)
    return both.withColumn("contract", F.when(kept, "PASS").otherwise("FAIL"))


def backlog(source: DataFrame, committed: DataFrame, key: str = "event_id", by: str | None = None) -> DataFrame:
    """Records read but not yet committed, in all or per source partition."""
    waiting = source.select(key, *([by] if by else [])).join(committed.select(key), key, "left_anti")
    return waiting.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("backlog"))


def live_backlog(progress: Mapping) -> int:
    """Messages a running query has not read yet, from its last progress report (partitioned sources).

    Offsets come as ``{topic: {partition: offset}}``, as JSON text or already parsed.
    """
    waiting = 0
    for source in progress["sources"]:
        latest, end = (
            json.loads(source[k]) if isinstance(source[k], str) else source[k] for k in ("latestOffset", "endOffset"))
        for topic, partitions in latest.items():
            for partition, offset in partitions.items():
                waiting += offset - end.get(topic, {}).get(partition, 0)
    return waiting


def snapshot_log(written: DataFrame, batch: str = "batch_id", committed: str = "committed_at") -> DataFrame:
    """One row per commit: records added, running total, commit time and which one is current.

    The windows run over one row per commit, not over records.
    """
    commits = written.groupBy(batch).agg(
        F.count(F.lit(1)).alias("records_added"), F.max(committed).alias("committed_at"))
    so_far = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_commits = Window.partitionBy(F.lit(1))
    return commits.select(
        F.concat(F.lit("snap-"), F.col(batch).cast("string")).alias("snapshot_id"),
        (F.col(batch) == F.max(batch).over(all_commits)).alias("current"),
        F.lit("append").alias("operation"),
        "records_added",
        F.sum("records_added").over(so_far).alias("total_records"),
        "committed_at",
        F.count(F.lit(1)).over(all_commits).alias("commit_count"),
    )


def duplicate_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Business keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("records")).where(F.col("records") > 1)
