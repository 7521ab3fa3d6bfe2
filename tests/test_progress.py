"""Progress rows: written once per batch, replaced by a replay, the source of backlog and checkpoint duration."""

import json

from pyspark.sql import functions as F

from sluiceway.operators import metrics
from sluiceway.streaming import progress


def report(batch, latest, end, took=None, query="q"):
    return json.dumps({"id": query, "runId": "r", "name": None, "batchId": batch, "timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": 5,
                       "durationMs": {"addBatch": 70, "triggerExecution": 100, "walCommit": 11, "commitOffsets": 4} if took is None else took,
                       "sources": [{"description": "s", "startOffset": None, "endOffset": end, "latestOffset": latest, "numInputRows": 5}]})


def test_rows_backlog_and_durations(spark, folder):
    log = progress.ProgressLog(spark, f"{folder}/log")
    log.record(report(0, {"t": {"0": 10, "1": 7}}, {"t": {"0": 1, "1": 7}}))
    log.record(report(0, {"t": {"0": 10, "1": 7}}, {"t": {"0": 4, "1": 7}}))  # the batch once more
    log.record(report(1, {"t": {"0": 12, "1": 9}, "new": {"0": 3}}, {"t": {"0": 12, "1": 9}}))
    log.record(report(2, None, {"logOffset": 3}))
    log.record(report(3, {"logOffset": 5}, {"logOffset": 3}, query="files"))
    log.record(report(3, {"t": {"0": 99}}, {"t": {"0": 0}}, took={"latestOffset": 3, "triggerExecution": 3}))  # an idle trigger
    rows = progress.read_progress(spark, f"{folder}/log")
    assert sorted((r.query_id, r.batch_id, r.input_rows, r.batch_ms, r.trigger_ms, r.checkpoint_duration_ms) for r in rows.collect()) == [
        ("files", 3, 5, 70, 100, 15), *(("q", n, 5, 70, 100, 15) for n in range(3))]
    assert rows.where("started_at = timestamp'2024-01-01 00:00:00'").count() == 4
    assert sorted(((r.query_id, r.batch_id, r.backlog) for r in progress.waiting(rows).collect()), key=str) == [
        ("files", 3, None), ("q", 0, 6), ("q", 1, 3), ("q", 2, None)]


def test_checkpoint_duration_in_the_metric_row(spark, folder):
    log = progress.ProgressLog(spark, f"{folder}/log")
    log.record(report(0, None, None))
    intervals = spark.sql("SELECT timestamp'2024-01-01' AS interval_start, 2L AS incoming, 1L AS valid_events, 1L AS invalid_events, 0L AS dlq_count, "
                          "0.1D AS throughput, 50.0D AS error_rate")
    newest = progress.read_progress(spark, f"{folder}/log").agg(F.max_by("checkpoint_duration_ms", "batch_id")).scalar()
    row = metrics.current_metrics(intervals, F.lit(1), F.lit(0), F.lit(2.5), newest).first()
    assert row["checkpoint_duration_ms"] == 15 and row["processed_total"] == 2
    assert "checkpoint_duration_ms" not in metrics.current_metrics(intervals, F.lit(1), F.lit(0), F.lit(2.5)).columns


def test_a_stream_reports_each_batch(spark, folder):
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    with progress.recorded(spark, f"{folder}/log") as log:
        for _ in range(2):  # the second start finds nothing new
            stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
            query = stream.writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/out/{n}")).option(
                "checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
            query.awaitTermination()
            log.wait_for(query)
    rows = progress.read_progress(spark, f"{folder}/log").collect()
    assert sorted((r.batch_id, r.input_rows) for r in rows) == [(0, 10), (1, 10), (2, 10)]
    assert all(r.checkpoint_duration_ms >= 0 and r.trigger_ms >= r.batch_ms for r in rows) and len({r.query_id for r in rows}) == 1
