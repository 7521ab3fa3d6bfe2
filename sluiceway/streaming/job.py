"""The streaming breaker: micro-batches through the batch operator, with the counters carried over.

Per batch, in this order: the routed records, then the breaker state. A batch starts from the state of the batch
before it, which is read by its exact path, and replaces its own files, so a batch that is run again after a
failure gives the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluiceway.functions.json_text import flag_anomalies
from sluiceway.operators.breaker import ORDER, annotate_diverted, circuit_breaker
from sluiceway.operators.running import ROWS_PER_SLICE
from sluiceway.schema import ERROR_THRESHOLD, MINIMUM_RECORDS
from sluiceway.session import configure
from sluiceway.sources.writers import write_routed

COUNTERS = "total bigint, failed bigint"


def state_path(root: str, batch_id: int) -> str:
    return f"{root}/breaker_state/batch_id={batch_id}"


def read_state(spark: SparkSession, root: str, key_schema: str = "") -> DataFrame:
    """The counters after every batch; ``key_schema`` declares the key columns of a keyed breaker."""
    columns = ", ".join(filter(None, [key_schema, COUNTERS, "batch_id bigint"]))
    return spark.read.schema(columns).parquet(f"{root}/breaker_state")


def _carried(batch: DataFrame, root: str, batch_id: int, key: Sequence[str]) -> DataFrame:
    """State left by the batch before this one; no rows before the first."""
    fields = [batch.schema[k] for k in key]
    schema = T.StructType([*fields, T.StructField("total", T.LongType()), T.StructField("failed", T.LongType())])
    if batch_id == 0:
        return batch.sparkSession.createDataFrame([], schema)
    return batch.sparkSession.read.schema(schema).parquet(state_path(root, batch_id - 1))


def run_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    order: Sequence[str] = ORDER,
    key: Sequence[str] = (),
    probe: str = "tax_amount",
    threshold: float = ERROR_THRESHOLD,
    min_records: int = MINIMUM_RECORDS,
    rows_per_slice: int = ROWS_PER_SLICE,
    persist: bool = False,
) -> None:
    """Route one micro-batch and record the breaker state after it.

    The batch is read several times with few columns each; ``persist`` keeps it instead, which pays off where
    reading is costly (a message broker) and not for columnar files.
    """
    key = list(key)
    carried = _carried(batch, root, batch_id, key)
    flagged = flag_anomalies(batch, probe=probe)
    if persist:
        flagged = flagged.persist()
    try:
        _route(batch, flagged, carried, batch_id, root, order, key, threshold, min_records, rows_per_slice)
    finally:
        if persist:
            flagged.unpersist()


def _route(
    batch: DataFrame, flagged: DataFrame, carried: DataFrame, batch_id: int, root: str, order: Sequence[str], key: list[str],
    threshold: float, min_records: int, rows_per_slice: int,
) -> None:
    # Without a key the state is a single row.
    carry = carried if key else next((r.asDict() for r in carried.collect()), {})
    routed = circuit_breaker(
        flagged, order=order, key=key, threshold=threshold, min_records=min_records, carry=carry,
        rows_per_slice=rows_per_slice)
    write_routed(annotate_diverted(routed), root, batch_id)
    # From the written files: a few narrow columns, and the batch is not worked out a second time.
    schema = T.StructType([*[batch.schema[k] for k in key], T.StructField("bad", T.BooleanType())])
    written = batch.sparkSession.read.schema(schema).parquet(f"{root}/events/batch_id={batch_id}")
    added = written.select(*key, F.lit(1).cast("bigint").alias("total"), F.col("bad").cast("bigint").alias("failed"))
    after = carried.unionByName(added).groupBy(*key).agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"))
    after.write.mode("overwrite").parquet(state_path(root, batch_id))


def start(
    events: DataFrame,
    root: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "10 seconds",
    **options,
) -> StreamingQuery:
    """Start the breaker on a stream of raw events; progress and restarts are kept in ``checkpoint``.

    ``options`` go to :func:`run_batch`.
    """
    configure(events.sparkSession)
    writer = events.writeStream.foreachBatch(lambda df, n: run_batch(df, n, root, **options)).option(
        "checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
