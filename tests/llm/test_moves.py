"""What is moved and what is left on disk, and that it is all the same whole."""

import collections
import glob
import os
import random

import pytest
from helpers import CLASHING, frame
from pyspark.sql import functions as F

from sluiceway.llm import common, mixing, sharding


def shuffled_bytes(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(f) for d in folders for f in glob.glob(f"{d}/**/shuffle_*", recursive=True))


def noise(seed, n=20_000):
    return "".join(map(chr, random.Random(seed).choices(range(33, 127), k=n)))


def test_cut_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffled_bytes(spark), spark.conf.get(setting)
    rows = common.cut(spark.range(200_000).groupBy(F.xxhash64("id").alias("k")).count(), "test-counts")
    assert shuffled_bytes(spark) - before < 100_000 and spark.conf.get(setting) == was
    assert rows.count() == 200_000


def test_sharding_moves_repeated_rows_once(spark, folder):
    docs = frame(spark, [(k, noise(k), "en", "s") for k in range(100) for _ in range(1 + k % 3)])
    docs.write.parquet(f"{folder}/docs")
    before, threshold = shuffled_bytes(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sharding.shard_rows(spark.read.parquet(f"{folder}/docs")).write.parquet(f"{folder}/out")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert shuffled_bytes(spark) - before < docs.count() * 20_000
    assert spark.read.parquet(f"{folder}/out").count() == docs.count()


@pytest.mark.parametrize("many", [5, 1000])
def test_places_of_repeated_rows(spark, monkeypatch, many):
    """Rows that are equal as a whole, or only in the keys, or not at all; nulls; more copies than one task takes."""
    monkeypatch.setattr(common, "MANY_COPIES", many)
    rows = ([(1, "a b c", "en", "s")] * 17 + [(None, None, None, None)] * 12 + [(2, "d e", "en", None)] * 3 + [(None, "f", "en", "s")]
            + [(k, "g " * k, "de", "t") for k in range(20)])
    docs = frame(spark, rows, CLASHING).withColumn("size", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(2)).cast("string"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = sharding.shard_rows(docs).collect()
    whole = lambda r: (r.doc_id, r.text, r.lang, r.source, r["size"])
    assert collections.Counter(map(whole, got)) == collections.Counter(map(whole, docs.collect()))
    assert sorted((r.shard, r.slot) for r in got) == sorted((r.shard, r.slot) for r in sharding.hilbert_shards(docs).collect())
    again = sharding.shard_rows(docs.repartition(3)).collect()
    place = lambda r: (whole(r), r.shard, r.slot)
    assert sorted(map(repr, map(place, got))) == sorted(map(repr, map(place, again)))
    mixed = collections.Counter(r.doc_id for r in mixing.mix(docs).collect())
    plan = mixing.mix_plan(docs).filter("taken > 0").select("doc_id", F.ceil(F.col("taken") / F.col("size")).alias("times"))
    assert mixed == {r.doc_id: r.times for r in plan.groupBy("doc_id").agg(F.sum("times").alias("times")).collect()}
