"""Circuit breaker: running error rate, routing, transitions and the current state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.json_text import annotate
from sluiceway.operators.running import running_sums
from sluiceway.schema import DLQ_TABLE, ERROR_THRESHOLD, MAIN_TABLE, MINIMUM_RECORDS

ORDER = ("event_ts", "event_id")


def is_open(total: Column, failed: Column, threshold: float = ERROR_THRESHOLD,
            min_records: int = MINIMUM_RECORDS) -> Column:
    """Open when enough records were seen and more than the threshold share failed."""
    return (total >= min_records) & (failed.cast("double") / F.nullif(total, F.lit(0)) > threshold)


def _failed(flag: str) -> Column:
    return F.coalesce(F.col(flag).cast("int"), F.lit(0))


def running_error_rate(
    df: DataFrame,
    flag: str = "bad",
    order: Sequence[str] = ORDER,
    key: Sequence[str] = (),
    carry: Mapping[str, int] | DataFrame | None = None,
    **options,
) -> DataFrame:
    """Add ``total`` and ``failed`` so far, the row itself included, and ``error_rate``."""
    counted = running_sums(
        df, {"total": F.lit(1), "failed": _failed(flag)}, order, key, carry=carry, **options)
    return counted.withColumn("error_rate", F.col("failed").cast("double") / F.col("total"))


def circuit_breaker(
    df: DataFrame,
    flag: str = "bad",
    order: Sequence[str] = ORDER,
    key: Sequence[str] = (),
    threshold: float = ERROR_THRESHOLD,
    min_records: int = MINIMUM_RECORDS,
    carry: Mapping[str, int] | DataFrame | None = None,
    **options,
) -> DataFrame:
    """Route every row: while the breaker is open, good and bad rows alike go to the dead-letter table.

    Counters run from the start (or from ``carry``) and never reset, so the breaker closes by itself once the
    rate has come down to the threshold. With ``key`` there is one breaker per key.
    """
    rated = running_error_rate(df, flag, order, key, carry, **options)
    opened = is_open(F.col("total"), F.col("failed"), threshold, min_records)
    return rated.withColumn("breaker_open", opened).withColumn(
        "route", F.when(F.col("breaker_open"), DLQ_TABLE).otherwise(MAIN_TABLE))


def annotate_diverted(routed: DataFrame, value: str = "value") -> DataFrame:
    """Give diverted rows the three diversion keys in their text; rows of the main table keep theirs."""
    text = F.when(F.col("breaker_open"), annotate(F.col(value), F.col("error_rate"))).otherwise(F.col(value))
    return routed.withColumn(value, text)


def transitions(
    routed: DataFrame, flag: str = "bad", threshold: float = ERROR_THRESHOLD, min_records: int = MINIMUM_RECORDS,
) -> DataFrame:
    """Rows at which the breaker opens or closes, with ``opened`` telling which.

    The counters before a row follow from the counters at it, so no neighbour has to be looked up.
    """
    was_open = F.coalesce(
        is_open(F.col("total") - 1, F.col("failed") - _failed(flag), threshold, min_records), F.lit(False))
    return (
        routed.where(F.col("breaker_open") != was_open)
        .withColumn("opened", F.col("breaker_open"))
    )


def breaker_state(
    routed: DataFrame, key: Sequence[str] = (), threshold: float = ERROR_THRESHOLD, min_records: int = MINIMUM_RECORDS,
) -> DataFrame:
    """The breaker after the last row: status, route and reason (one row, or one per key).

    ``total`` grows by one per row, so the row with the largest total is the last one.
    """
    last = routed.groupBy(*key).agg(
        F.max("total").alias("total"), F.max_by("failed", "total").alias("failed"),
    ).where(F.col("total").isNotNull())
    return describe_state(last, key, threshold, min_records)


def state_after(
    flagged: DataFrame, key: Sequence[str] = (), flag: str = "bad", threshold: float = ERROR_THRESHOLD,
    min_records: int = MINIMUM_RECORDS,
) -> DataFrame:
    """The same state from rows that have not been routed: two sums, without an order."""
    counted = flagged.groupBy(*key).agg(F.count(F.lit(1)).alias("total"), F.sum(_failed(flag)).alias("failed"))
    return describe_state(counted.where("total > 0"), key, threshold, min_records)


def describe_state(
    counters: DataFrame, key: Sequence[str] = (), threshold: float = ERROR_THRESHOLD,
    min_records: int = MINIMUM_RECORDS,
) -> DataFrame:
    """Counters to status, route and reason text."""
    total, failed = F.col("total"), F.col("failed")
    opened = F.coalesce(is_open(total, failed, threshold, min_records), F.lit(False))
    rate = F.coalesce(failed.cast("double") / F.nullif(total, F.lit(0)), F.lit(0.0))
    reason = F.when(opened, F.concat(
        F.lit(f"Null tax ratio exceeded {threshold * 100:g}% safety threshold. Current rate: "),
        F.round(rate * 100, 2).cast("string"), F.lit("%"))).otherwise(F.lit("Data streams healthy"))
    return counters.select(
        *key, "total", "failed", rate.alias("error_rate"),
        F.when(opened, "ENGAGED").otherwise("CLOSED").alias("status"),
        F.when(opened, DLQ_TABLE).otherwise(MAIN_TABLE).alias("route"), reason.alias("reason"))
