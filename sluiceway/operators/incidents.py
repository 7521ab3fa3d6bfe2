"""Incidents from breaker transitions and from intervals with too many null taxes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.metrics import seconds
from sluiceway.operators.running import running_sums
from sluiceway.operators.validation import null_ratio_percent
from sluiceway.schema import ERROR_THRESHOLD

BREAKER_MESSAGE = "Circuit breaker engaged and events diverted to DLQ."


def breaker_rule(threshold: float = ERROR_THRESHOLD) -> str:
    return f"tax_amount null ratio exceeded {threshold * 100:g}% safety threshold"


def warning_rule(share_percent: float = 10.0) -> str:
    return f"tax_amount should not be null > {share_percent:g}% of rows"


def _digits(column: Column, kind: T.DataType) -> Column:
    """A value as it stands in an id: times in microseconds since 1970, in which no two of them are alike."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        column = F.unix_micros(column.cast("timestamp"))
    return F.coalesce(column.cast("string"), F.lit("null"))


def breaker_incidents(
    changes: DataFrame,
    order: Sequence[str] = ("event_ts", "event_id"),
    key: Sequence[str] = (),
    node: str = "circuit breaker",
    threshold: float = ERROR_THRESHOLD,
    at_column: str | None = None,
    **options,
) -> DataFrame:
    """One incident per opening, resolved by the closing that follows it; with ``key``, of the same key.

    Openings and closings of a key alternate, so both of an incident carry the same number of openings so far; grouping
    by that number pairs them without looking at neighbours. The id holds the key and all order columns, so no two
    incidents share one: offsets repeat between partitions, and times between keys. ``at_column`` adds the order columns
    of the opening as a struct.
    """
    numbered = running_sums(
        changes.select(*key, *order, "opened"), {"number": F.col("opened").cast("int")}, order, key, **options)
    at = F.struct(*order)
    paired = numbered.groupBy(*key, "number").agg(
        F.max(F.when(F.col("opened"), at)).alias("opened"),
        F.max(F.when(~F.col("opened"), F.col(order[0]))).alias("resolved_at"),
    ).where(F.col("opened").isNotNull())
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key]
    parts += [_digits(F.col("opened")[name], changes.schema[name].dataType) for name in order]
    return paired.select(
        *key,
        F.concat_ws("-", F.lit("INC"), *parts).alias("incident_id"),
        F.col("opened")[order[0]].alias("opened_at"),
        F.lit("CRITICAL").alias("severity"),
        F.lit(breaker_rule(threshold)).alias("rule_violated"),
        F.lit(node).alias("affected_node"),
        F.lit(BREAKER_MESSAGE).alias("message"),
        F.col("resolved_at").isNotNull().alias("resolved"),
        "resolved_at",
        *([F.col("opened").alias(at_column)] if at_column else []),
    )


def warning_incidents(
    metrics: DataFrame, interval: str, share_percent: float = 10.0, node: str = "validator",
) -> DataFrame:
    """A warning per interval whose null-tax share is above the limit; it is over with the interval.

    ``interval`` is the width that ``metrics`` were counted with; start and width in seconds make the id.
    """
    width = f"{seconds(interval):g}"
    percent = null_ratio_percent(F.col("null_tax_count"), F.col("incoming"))
    over = metrics.where(F.col("null_tax_count") * 100.0 > share_percent * F.col("incoming"))
    return over.select(
        F.concat(F.lit("INC-W"), F.date_format("interval_start", "yyyyMMddHHmmss"), F.lit(f"-{width}")).alias("incident_id"),
        F.col("interval_start").alias("opened_at"),
        F.lit("WARNING").alias("severity"),
        F.lit(warning_rule(share_percent)).alias("rule_violated"),
        F.lit(node).alias("affected_node"),
        F.concat(F.lit("Data validation warning: Null tax_amount rate touched "), percent.cast("string"),
                 F.lit("%.")).alias("message"),
        F.lit(True).alias("resolved"),
    )


def latest(incidents: DataFrame, count: int = 5) -> DataFrame:
    return incidents.orderBy(F.col("opened_at").desc(), F.col("incident_id").desc()).limit(count)


def active(incidents: DataFrame) -> DataFrame:
    return incidents.where(~F.col("resolved"))


def deduplicated(incidents: DataFrame) -> DataFrame:
    """Each incident id once; on a stream with a watermark repeats are dropped within it."""
    if incidents.isStreaming:
        return incidents.dropDuplicatesWithinWatermark(["incident_id"])
    return incidents.dropDuplicates(["incident_id"])


def pipeline_status(state: DataFrame) -> DataFrame:
    """Health labels that follow from the breaker state (one row)."""
    engaged = F.col("status") == "ENGAGED"
    return state.select(
        F.when(engaged, "DEGRADED").otherwise("HEALTHY").alias("pipeline_health"),
        F.when(engaged, "OPEN").otherwise("CLOSED").alias("circuit_breaker"),
        F.when(engaged, "PROTECTED").otherwise("OPERATIONAL").alias("storage"),
        F.when(engaged, "DEGRADED").otherwise("OPERATIONAL").alias("quality"),
        "route", "reason",
    )
