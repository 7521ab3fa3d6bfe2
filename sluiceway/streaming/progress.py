"""Progress of streams as rows: which batch took which offsets, how many records, and how long it and its checkpoint took.

A listener writes one small file per batch, named by query and batch, so a batch that runs again replaces its row. The rows
are what backlog and checkpoint duration are read from; Spark's own checkpoint files are not looked at.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

REPORT = ("id string, runId string, name string, batchId bigint, timestamp string, numInputRows bigint, durationMs map<string,bigint>, "
          "sources array<struct<description:string,startOffset:string,endOffset:string,latestOffset:string,numInputRows:bigint>>")
OFFSETS = "map<string,map<string,bigint>>"


class ProgressLog(StreamingQueryListener):
    """Writes the report of each finished batch below ``path``; reports of idle triggers are left out."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def record(self, report: str) -> None:
        """One report as JSON text. Done by the driver: it is one row per batch, whatever the batch holds."""
        parsed = json.loads(report)
        if "addBatch" not in parsed.get("durationMs", {}):
            return
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{parsed['id']}-{parsed['batchId']}.json")
        out = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray((json.dumps(parsed) + "\n").encode()))
        finally:
            out.close()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(event.progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all reports of a query that has ended are written; they come in order and after the query's own end."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} was reported within {seconds} seconds")


@contextmanager
def recorded(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """Record the progress of all streams of the session for as long as the block runs."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch, with ``checkpoint_duration_ms``: what writing the batch's offsets and its commit took.

    ``input_rows`` is Spark's count of rows read; a batch that is read twice counts twice there, so how many records a batch
    holds is a matter of its commit row.
    """
    took = F.col("durationMs")
    return spark.read.schema(REPORT).option("pathGlobFilter", "*.json").json(path).select(
        F.col("id").alias("query_id"), F.col("runId").alias("run_id"), F.col("batchId").alias("batch_id"),
        F.to_timestamp("timestamp").alias("started_at"), F.col("numInputRows").alias("input_rows"),
        took["addBatch"].alias("batch_ms"), took["triggerExecution"].alias("trigger_ms"),
        (F.coalesce(took["walCommit"], F.lit(0)) + F.coalesce(took["commitOffsets"], F.lit(0))).alias("checkpoint_duration_ms"),
        "sources")


def waiting(progress: DataFrame) -> DataFrame:
    """Messages that partitioned sources held and a batch had not read at its end, per query, batch and source.

    Offsets are maps of topic to partition to offset. Sources that do not say how far they reach give null.
    """
    def by_partition(name: str) -> Column:
        parsed = F.from_json(F.col("source")[name], OFFSETS)
        return F.map_from_entries(F.flatten(F.transform(F.map_entries(parsed), lambda topic: F.transform(
            F.map_entries(topic["value"]), lambda p: F.struct(F.concat_ws("/", topic["key"], p["key"]), p["value"])))))

    rows = progress.select("query_id", "batch_id", F.explode("sources").alias("source"))
    ends = rows.select("query_id", "batch_id", F.col("source.description").alias("source"),
                       by_partition("latestOffset").alias("latest"), by_partition("endOffset").alias("end"))
    # A source with other offsets parses to a map without partitions, or to none.
    left = F.aggregate(F.map_entries("latest"), F.lit(0).cast("bigint"), lambda total, p: total + F.greatest(
        p["value"] - F.coalesce(F.try_element_at("end", p["key"]), F.lit(0)), F.lit(0)))
    return ends.select("query_id", "batch_id", "source", F.when(F.size("latest") > 0, left).alias("backlog"))
