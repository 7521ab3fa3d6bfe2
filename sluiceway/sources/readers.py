"""Sources: message streams, file streams, JSON and CSV batches, saved reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.json_text import decode_value, with_variant
from sluiceway.functions.scalars import normalize_time
from sluiceway.schema import ARRIVAL, CANONICAL, MONEY, REPORT, TRANSACTIONS_CSV, VALIDATOR_BATCH


def read_events(
    spark: SparkSession, source: str, schema: T.StructType = ARRIVAL, stream: bool = True, **options: str,
) -> DataFrame:
    """Raw events from ``kafka`` or from files (``parquet``, ``json``, ``orc``).

    Kafka takes ``servers``, ``topic`` and optionally ``starting`` (default: latest), and needs the connector
    package on the class path. Files take ``path``; other options go to the reader as they are.
    """
    reader = spark.readStream if stream else spark.read
    if source == "kafka":
        raw = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", options.pop("servers"))
            .option("subscribe", options.pop("topic"))
            .option("startingOffsets", options.pop("starting", "latest" if stream else "earliest"))
            .options(**options)
            .load()
        )
        return decode_value(raw)
    path = options.pop("path")
    return reader.format(source).schema(schema).options(**options).load(path)


def read_json_batch(spark: SparkSession, path: str, schema: T.StructType = VALIDATOR_BATCH) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv_batch(spark: SparkSession, path: str, schema: T.StructType = TRANSACTIONS_CSV) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Saved reports; text that cannot be read gives a row of nulls, a missing path gives no rows."""
    try:
        return spark.read.schema(REPORT).option("multiLine", True).json(path)
    except Exception as error:  # the reader checks the path when it is built
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], REPORT)
        raise


def report_with_fallback(saved: DataFrame, computed: DataFrame) -> DataFrame:
    """The newest readable saved report, or the computed one when there is none. One row."""
    fields = [f.name for f in REPORT]
    newest = saved.where(F.col("status").isNotNull()).orderBy(F.col("timestamp").desc_nulls_last()).limit(1)
    candidates = newest.select(*fields, F.lit(0).alias("__rank")).unionByName(
        computed.select(*fields, F.lit(1).alias("__rank")))
    return candidates.orderBy("__rank").limit(1).drop("__rank")


def canonicalize(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    """One source shape to the canonical record: named columns converted, all others null."""
    unknown = set(mapping) - {f.name for f in CANONICAL}
    if unknown:
        raise ValueError(f"not canonical: {sorted(unknown)}")
    return df.select(*[
        mapping.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CANONICAL
    ])


def from_generator_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Checkout events as JSON text."""
    def get(name: str, kind: str) -> Column:
        return F.try_variant_get("doc", f"$['{name}']", kind)

    return canonicalize(with_variant(df, value, "doc"), {
        "event_ts": normalize_time(get("timestamp", "string")),
        "order_id": get("order_id", "string"), "user_id": get("user_id", "string"),
        "amount": get("amount", "decimal(18,2)"), "tax_amount": get("tax_amount", "decimal(18,2)"),
        "currency": get("currency", "string"), "country": get("country", "string"),
        "payment_method": get("payment_method", "string"), "value": F.col(value),
    })


def from_transaction(df: DataFrame, record: str = "record") -> DataFrame:
    """Typed transaction records (camelCase members)."""
    r = F.col
    return canonicalize(df, {
        "event_ts": normalize_time(r(f"{record}.eventTimestamp")),
        "order_id": r(f"{record}.transactionId"), "user_id": r(f"{record}.userId"),
        "product_id": r(f"{record}.productId"), "quantity": r(f"{record}.quantity"),
        "amount": r(f"{record}.price"), "tax_amount": r(f"{record}.taxAmount"),
        "payment_method": r(f"{record}.paymentMethod"),
    })


def from_validator_batch(df: DataFrame) -> DataFrame:
    """Validator records: time in epoch milliseconds."""
    c = F.col
    return canonicalize(df, {
        "event_ts": normalize_time(c("timestamp")), "order_id": c("order_id"), "user_id": c("user_id"),
        "amount": c("amount"), "tax_amount": c("tax_amount"), "status": c("status"),
    })


def from_transactions_csv(df: DataFrame) -> DataFrame:
    c = F.col
    return canonicalize(df, {
        "event_ts": normalize_time(c("timestamp")), "order_id": c("transaction_id"), "user_id": c("user_id"),
        "amount": c("amount").cast(MONEY), "tax_amount": c("tax_amount"),
    })
