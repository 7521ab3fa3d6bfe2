"""Histograms of delay against exact order statistics; bounded state; merging."""

import math
import random

from pyspark.sql import functions as F

from sluiceway.functions import histogram as h
from sluiceway.operators import metrics
from sluiceway.streaming import pipeline


def rank(values, q):
    return sorted(values)[math.ceil(round(q * len(values), 9)) - 1]


def test_quantiles_are_within_the_stated_error(spark):
    rng = random.Random(3)
    values = {"long": [int(rng.lognormvariate(8, 3)) for _ in range(5000)], "signed": [rng.randint(-10**6, 10**6) for _ in range(3001)],
              "same": [777] * 100, "one": [5], "edge": [2**63 - 1, -2**63, 0, -1, 1]}
    frame = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs] + [("long", None), ("nothing", None)], "g string, v bigint")
    for bits in (4, 7):
        quantiles = (0.01, 0.5, 0.95, 0.999)
        calm = frame.where("g <> 'edge'")
        rows = h.histogram(calm, "v", ["g"], bits)
        got = {r.g: r for r in h.summary(rows, ["g"], "v", quantiles).collect()}
        assert set(got) == {"long", "signed", "same", "one"}
        for g, row in got.items():
            assert row.records == len(values[g]) and row.max_v == max(values[g]) and math.isclose(row.avg_v, sum(values[g]) / len(values[g]))
            for q, name in zip(quantiles, ("p1_v", "p50_v", "p95_v", "p99_9_v"), strict=True):
                true = rank(values[g], q)
                assert abs(row[name] - true) <= abs(true) * 2**-bits, (g, q)
        assert rows.groupBy("g").count().agg(F.max("count")).first()[0] <= 128 * 2 ** (bits - 1)
    ends = {r.v: r.b for r in frame.where("g = 'edge'").select("v", h.bucket_of(F.col("v")).alias("b")).collect()}
    assert ends == {2**63 - 1: 127 << 56, -2**63: -(127 << 56), 0: 0, 1: 1, -1: -1}
    assert h.quantile_name(0.5, "x") == "p50_x" and h.quantile_name(0.999, "x") == "p99_9_x" and h.quantile_name(1.0, "x") == "p100_x"


def test_a_million_delays_take_few_buckets_and_merge_in_any_cut(spark):
    many = spark.range(1_000_000).select(F.timestamp_seconds(F.col("id") % 60).alias("event_ts"), "id").withColumn(
        "ingest_ts", F.timestamp_millis(F.unix_millis("event_ts") + F.col("id")))
    whole = metrics.latency_histogram(many)
    assert whole.count() <= 128 + 13 * 64  # below 2 ** 20
    parts = [metrics.latency_histogram(many.where(F.col("id") % 7 == k)) for k in range(7)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    first, second = (sorted(map(tuple, metrics.latency_windows(x).collect())) for x in (whole, union))
    assert first == second and len(first) == 5
    assert all(abs(r[4] - 499_999) <= 499_999 / 128 for r in first)


def test_no_rows_and_missing_times(spark):
    empty = spark.createDataFrame([], "event_ts timestamp, ingest_ts timestamp")
    assert metrics.latency_windows(metrics.latency_histogram(empty)).count() == 0
    rows = spark.sql("SELECT timestamp'2024-01-01 00:00:30' AS event_ts, timestamp'2024-01-01 00:00:31' AS ingest_ts, 1 AS bucket, 2 AS n UNION ALL "
                     "SELECT timestamp'2024-01-01 00:00:30', null, 1, 2 UNION ALL SELECT null, timestamp'2024-01-01 00:00:31', 1, 2")
    assert {(r.records, r.avg_latency_ms, r.p99_latency_ms) for r in metrics.latency_windows(metrics.latency_histogram(rows)).collect()} == {(1, 1000.0, 1000.0)}


def test_stream_histograms_after_folds_and_replays(spark, folder):
    plain = spark.range(40).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_040 + F.col("id")).alias("event_ts"),
        F.timestamp_seconds(1_700_000_041 + F.col("id") * 2).alias("ingest_ts"), F.lit('{"amount":1.00,"tax_amount":0.08}').alias("value"))
    settings = pipeline.Pipeline(folder, fold_every=2)
    for n in range(5):
        part = plain.where(F.col("event_id") % 5 == n)
        pipeline.run_message_batch(part, n, settings)
        if n % 2:
            pipeline.run_message_batch(part, n, settings)
    got = sorted(map(tuple, pipeline.read_latency(spark, settings).collect()))
    assert got == sorted(map(tuple, metrics.latency_windows(metrics.latency_histogram(plain)).collect()))
    assert sum(r.n for r in settings.latency().read(spark).collect()) == 40
