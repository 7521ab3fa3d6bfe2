"""Sinks: the routed tables, message payloads and saved reports.

A batch is written below ``batch_id=N`` in one pass, split by route, so main and dead-letter records come from a
single evaluation. Writing the same batch again replaces exactly its own files, also when it has become empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.json_text import to_json_text
from sluiceway.schema import DLQ_TABLE, DLQ_TOPIC, MAIN_TABLE, PROCESSED_TOPIC


def write_routed(routed: DataFrame, root: str, batch_id: int = 0, fmt: str = "parquet") -> None:
    """Write one batch to both tables; the text column should already carry the diversion keys."""
    target = f"{root}/events/batch_id={batch_id}"
    routed.write.mode("overwrite").partitionBy("route").format(fmt).save(target)


def read_routed(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """All written records with ``route`` and ``batch_id``. ``schema`` is that of the written frame."""
    fields = [f for f in schema.fields if f.name not in ("route", "batch_id")]
    full = T.StructType([
        *fields, T.StructField("batch_id", T.LongType()), T.StructField("route", T.StringType())])
    return spark.read.format(fmt).schema(full).load(f"{root}/events")


def read_main(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    return read_routed(spark, root, schema, fmt).where(F.col("route") == MAIN_TABLE)


def read_dlq(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    return read_routed(spark, root, schema, fmt).where(F.col("route") == DLQ_TABLE)


def append_to_catalog(routed: DataFrame, batch_id: int, main: str = MAIN_TABLE, dlq: str = DLQ_TABLE) -> None:
    """The same two tables as catalog tables of a format with row-level overwrite (partitioned by batch_id).

    The frame is evaluated once per table here; cache it first if it is expensive.
    """
    tagged = routed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    for table, name in ((main, MAIN_TABLE), (dlq, DLQ_TABLE)):
        tagged.where(F.col("route") == name).drop("route").writeTo(table).overwrite(F.col("batch_id") == batch_id)


def keyed_json(df: DataFrame, key: str = "order_id", record: Column | None = None) -> DataFrame:
    """Messages with the business key and the whole record as JSON, nulls written out."""
    body = F.struct("*") if record is None else record
    return df.select(F.col(key).alias("key"), to_json_text(body).alias("value"))


def topic_payloads(df: DataFrame, diverted: Column, key: str = "order_id", value: str = "value") -> DataFrame:
    """Messages for the processed topic and the dead-letter topic, as one frame with a ``topic`` column."""
    return df.select(
        F.when(diverted, DLQ_TOPIC).otherwise(PROCESSED_TOPIC).alias("topic"),
        F.col(key).alias("key"), F.col(value).alias("value"))


def publish(payloads: DataFrame, servers: str) -> None:
    """Send messages to Kafka; the topic column decides where. Needs the connector package."""
    payloads.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def save_report(report: DataFrame, path: str, history: str | None = None) -> None:
    """Replace the saved report with this one-row frame; with ``history`` also append it there."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    if history:
        report.write.mode("append").parquet(history)
