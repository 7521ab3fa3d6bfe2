"""The stream gives what the batch operator gives, also after replays and restarts."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.json_text import decode_value, flag_anomalies
from sluiceway.operators import breaker, incidents, metrics
from sluiceway.plans.checkout import checkout_events
from sluiceway.sources import readers, writers
from sluiceway.streaming import job, windows

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("event_ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()), T.StructField("value", T.StringType())])
WRITTEN = T.StructType([
    *SCHEMA.fields, T.StructField("total", T.LongType()), T.StructField("failed", T.LongType()),
    T.StructField("route", T.StringType())])


def events(spark):
    # Two thirds of the records belong to one user.
    user = F.when(F.col("event_id") % 3 < 2, 1).otherwise(F.col("event_id") % 40).cast("bigint")
    return checkout_events(spark, SF_DIR).select(
        "event_id", F.col("event_ts").cast("timestamp"), user.alias("user_id"), "value")


def arrive(spark, folder, low, high):
    """One more file, in arrival order."""
    events(spark).where(f"event_id >= {low} AND event_id < {high}").coalesce(1).write.mode("append").parquet(
        f"{folder}/inbox")


def run(spark, folder, **options):
    stream = readers.read_events(spark, "parquet", SCHEMA, path=f"{folder}/inbox", maxFilesPerTrigger="1")
    query = job.start(stream, folder, f"{folder}/checkpoint", available_now=True, **options)
    query.awaitTermination()
    assert query.exception() is None


def table(spark, folder):
    rows = writers.read_routed(spark, folder, WRITTEN).collect()
    return sorted((r["event_id"], r["total"], r["failed"], r["route"], r["value"]) for r in rows)


def expected(spark, **options):
    rows = breaker.annotate_diverted(breaker.circuit_breaker(flag_anomalies(events(spark)), **options)).collect()
    return sorted((r["event_id"], r["total"], r["failed"], r["route"], r["value"]) for r in rows)


def state(spark, folder):
    return sorted(tuple(r) for r in job.read_state(spark, folder).select("batch_id", "total", "failed").collect())


def test_batches_replays_and_restarts(spark, folder):
    cuts = [0, 7, 60, 400]
    for low, high in zip(cuts, cuts[1:]):
        arrive(spark, folder, low, high)
    run(spark, folder)
    assert [s[:2] for s in state(spark, folder)] == [(0, 7), (1, 60), (2, 400)]
    # A restart goes on with what is new only.
    arrive(spark, folder, 400, 1000)
    run(spark, folder)
    run(spark, folder)
    whole = expected(spark)
    assert table(spark, folder) == whole
    states = state(spark, folder)
    assert len(states) == 4 and states[-1] == (3, 1000, 22)
    # The last batch once more, as after a crash before its commit, and once after a crash in the middle.
    again = events(spark).where("event_id >= 400")
    job.run_batch(again, 3, folder)
    assert table(spark, folder) == whole and state(spark, folder) == states
    writers.write_routed(again.limit(5).withColumns(
        {"total": F.lit(0), "failed": F.lit(0), "route": F.lit("ecommerce_events")}), folder, 3)
    job.run_batch(again, 3, folder, persist=True)
    assert table(spark, folder) == whole and state(spark, folder) == states


def test_an_empty_batch_keeps_the_state(spark, folder):
    job.run_batch(events(spark).where("event_id < 100"), 0, folder)
    job.run_batch(events(spark).where("event_id < 0"), 1, folder)
    assert state(spark, folder)[0][1:] == state(spark, folder)[1][1:]
    job.run_batch(events(spark).where("event_id >= 100"), 2, folder)
    assert table(spark, folder) == expected(spark)


def test_first_batch_empty(spark, folder):
    job.run_batch(events(spark).where("event_id < 0"), 0, folder)
    assert state(spark, folder) == [(0, 0, 0)]


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 20])
def test_breaker_per_user(spark, folder, rows_per_slice):
    options = {"key": ["user_id"], "min_records": 5, "rows_per_slice": rows_per_slice}
    for n, (low, high) in enumerate([(0, 300), (300, 301), (301, 1000)]):
        job.run_batch(events(spark).where(f"event_id >= {low} AND event_id < {high}"), n, folder, **options)
    assert table(spark, folder) == expected(spark, key=["user_id"], min_records=5)
    per_user = job.read_state(spark, folder, "user_id bigint").where("batch_id = 2")
    assert per_user.count() == events(spark).select("user_id").distinct().count()
    assert per_user.agg(F.sum("total"), F.sum("failed")).first()[:] == (1000, 22)


def test_broker_order(spark, folder):
    """Messages as a broker hands them over: bytes, partition, offset and a time many of them share."""
    messages = events(spark).select(
        F.encode("value", "UTF-8").alias("value"), (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.date_trunc("day", "event_ts").alias("timestamp"))
    decoded = decode_value(messages)
    order = ["timestamp", "partition", "offset"]
    job.run_batch(decoded.where("timestamp < '2024-01-09'"), 0, folder, order=order, persist=True, rows_per_slice=30)
    job.run_batch(decoded.where("timestamp >= '2024-01-09'"), 1, folder, order=order, persist=True, rows_per_slice=30)
    whole = breaker.circuit_breaker(flag_anomalies(decoded), order=order).select("offset", "total", "failed", "route")
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("offset", T.LongType()), ("total", T.LongType()), ("failed", T.LongType()), ("route", T.StringType()))])
    got = writers.read_routed(spark, folder, schema).select("offset", "total", "failed", "route")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_timed_trigger(spark, folder):
    arrive(spark, folder, 0, 1000)
    stream = readers.read_events(spark, "parquet", SCHEMA, path=f"{folder}/inbox")
    query = job.start(stream, folder, f"{folder}/checkpoint", interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert table(spark, folder) == expected(spark)


def _memory(query_frame, folder, name):
    query_frame.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{folder}/c").outputMode(
        "append").trigger(availableNow=True).start().awaitTermination()


def test_sliding_windows_equal_batch(spark, folder):
    arrive(spark, folder, 0, 1000)
    stream = flag_anomalies(readers.read_events(spark, "parquet", SCHEMA, path=f"{folder}/inbox"))
    out = windows.windowed_counts(stream, "5 minutes", "1 minute")
    _memory(out, folder, "sliding")
    batch = metrics.rolling_null_ratio(flag_anomalies(events(spark)), F.col("bad"))
    limit = events(spark).agg(F.max("event_ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    due = batch.where(F.col("window_end") <= F.lit(limit))
    got = spark.table("sliding").select("window_start", "records", "flagged").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, due.select("window_start", "records", "flagged").collect()))


def test_repeated_incidents_on_a_stream(spark, folder):
    rng = random.Random(1)
    rows = [(f"INC-{rng.randrange(20)}", 1_700_000_000 + i) for i in range(100)]
    spark.createDataFrame(rows, "incident_id string, at bigint").select(
        "incident_id", F.timestamp_seconds("at").alias("opened_at")).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("incident_id string, opened_at timestamp").parquet(f"{folder}/in")
    _memory(incidents.deduplicated(stream.withWatermark("opened_at", "1 hour")), folder, "incidents_once")
    got = [r[0] for r in spark.table("incidents_once").collect()]
    assert sorted(got) == sorted({r[0] for r in rows})


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.read_events(spark, "kafka", servers="localhost:1", topic="checkout_events")
