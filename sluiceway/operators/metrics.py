"""Interval metrics, running totals, latency and the chart series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.histogram import BITS, histogram, merged, summary
from sluiceway.operators.rules import is_valid, null_tax
from sluiceway.operators.running import running_sums
from sluiceway.operators.validation import null_ratio_percent
from sluiceway.schema import WARNING_BAND_PERCENT

COUNTERS = ("incoming", "valid_events", "invalid_events", "null_tax_count", "negative_amount_count", "dlq_count")


def interval_counters() -> list[Column]:
    """The per-interval counters; all are plain sums, so intervals can be added up later."""
    amount, tax = F.col("amount"), F.col("tax_amount")
    good = is_valid(amount, tax)
    return [
        F.count(F.lit(1)).alias("incoming"),
        F.count_if(good).alias("valid_events"),
        F.count_if(~good).alias("invalid_events"),
        F.count_if(null_tax(tax)).alias("null_tax_count"),
        F.count_if(amount <= 0).alias("negative_amount_count"),
        F.count_if(F.col("breaker_open")).alias("dlq_count"),
    ]


def seconds(interval: str) -> int:
    count, unit = interval.split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def metrics_by_interval(
    routed: DataFrame, interval: str = "1 minute", ts: str = "event_ts",
) -> DataFrame:
    """Counters, throughput and error rate per tumbling interval, and the breaker at its end."""
    # The running total names the last row with one number, which keeps this a hash aggregate.
    last_open = F.max_by("breaker_open", "total").alias("breaker_open")
    grouped = routed.groupBy(F.window(ts, interval).alias("w")).agg(*interval_counters(), last_open)
    return grouped.select(
        F.col("w.start").alias("interval_start"),
        *COUNTERS,
        (F.col("incoming") / seconds(interval)).alias("throughput"),
        (F.col("invalid_events") * 100.0 / F.col("incoming")).alias("error_rate"),
        "breaker_open",
    )


def running_totals(metrics: DataFrame, counters: Sequence[str] = ("incoming", "valid_events", "invalid_events",
                                                                  "dlq_count")) -> DataFrame:
    """Totals since the start, per interval. Days are the slices, each of at most a day's intervals."""
    names = {"incoming": "processed_total", "valid_events": "valid_total", "invalid_events": "invalid_total",
             "dlq_count": "dlq_total"}
    by_day = metrics.select("interval_start", *counters).withColumn("__day", F.unix_date(
        F.col("interval_start").cast("date")).cast("bigint"))
    out = running_sums(
        by_day, {names[c]: F.col(c) for c in counters}, ["interval_start"], slice_columns=["__day"])
    return out.select("interval_start", *[names[c] for c in counters])


def metric_band(metrics: DataFrame) -> DataFrame:
    """Add the label: breaker on, error rate in the warning band, or healthy."""
    band = (
        F.when(F.col("breaker_open"), "CRITICAL")
        .when(F.col("error_rate") >= WARNING_BAND_PERCENT, "WARNING")
        .otherwise("HEALTHY")
    )
    return metrics.withColumn("band", band)


def latest_series(metrics: DataFrame, points: int = 30) -> DataFrame:
    """The newest intervals in time order, with a clock label."""
    newest = metrics.orderBy(F.col("interval_start").desc()).limit(points)
    return newest.select(
        "interval_start", F.date_format("interval_start", "HH:mm:ss").alias("time_label"), "throughput", "error_rate",
    ).orderBy("interval_start")


def _sliding(slices: DataFrame, width: str, step: str, counters: Sequence[str]) -> DataFrame:
    return (
        slices.groupBy(F.window("slice_start", width, step).alias("w"))
        .agg(*[F.sum(c).alias(c) for c in counters])
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *counters)
    )


def rolling_null_ratio(
    df: DataFrame, flag: Column, width: str = "5 minutes", step: str = "1 minute", ts: str = "event_ts",
) -> DataFrame:
    """Share of flagged records in sliding windows.

    Rows are first counted per step; only those counts are copied into the overlapping windows.
    """
    slices = (
        df.groupBy(F.window(ts, step).alias("s"))
        .agg(F.count(F.lit(1)).alias("records"), F.count_if(flag).alias("flagged"))
        .select(F.col("s.start").alias("slice_start"), "records", "flagged")
    )
    rolled = _sliding(slices, width, step, ["records", "flagged"])
    return rolled.withColumn("ratio", F.col("flagged") / F.col("records"))


def rolling_latency(
    df: DataFrame, width: str = "5 minutes", step: str = "1 minute", ts: str = "event_ts", ingest: str = "ingest_ts",
) -> DataFrame:
    """Mean, maximum and 95th percentile of ingest delay in sliding windows.

    Equal delays of a step are counted first, so what is copied into the overlapping windows is at most one
    row per step and millisecond of delay.
    """
    delay = F.unix_millis(F.col(ingest).cast("timestamp")) - F.unix_millis(F.col(ts).cast("timestamp"))
    counted = (
        df.select(F.window(ts, step).alias("s"), delay.alias("latency_ms"))
        .groupBy(F.col("s.start").alias("slice_start"), "latency_ms").agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counted.groupBy(F.window("slice_start", width, step).alias("w"))
        .agg(
            F.sum("n").alias("records"),
            (F.sum(F.col("latency_ms") * F.col("n")) / F.sum("n")).alias("avg_latency_ms"),
            F.max("latency_ms").alias("max_latency_ms"),
            F.percentile("latency_ms", 0.95, F.col("n")).alias("p95_latency_ms"),
        )
        .select(F.col("w.start").alias("window_start"), "records", "avg_latency_ms", "max_latency_ms",
                "p95_latency_ms")
    )


def delay_ms(ts: str = "event_ts", ingest: str = "ingest_ts") -> Column:
    return F.unix_millis(F.col(ingest).cast("timestamp")) - F.unix_millis(F.col(ts).cast("timestamp"))


def latency_histogram(
    df: DataFrame, step: str = "1 minute", ts: str = "event_ts", ingest: str = "ingest_ts", bits: int = BITS,
) -> DataFrame:
    """Histogram of ingest delay per step: additive, so histograms of batches or partitions can be merged later.

    Records without event or ingest time are not in it.
    """
    delays = df.select(F.window(ts, step)["start"].alias("slice_start"), delay_ms(ts, ingest).alias("__delay"))
    return histogram(delays, "__delay", ["slice_start"], bits)


def latency_windows(
    steps: DataFrame, width: str = "5 minutes", step: str = "1 minute", quantiles: Sequence[float] = (0.5, 0.95, 0.99),
) -> DataFrame:
    """Mean, maximum and quantiles of delay in sliding windows, merged from the histograms of ``latency_histogram``.

    What is copied into the overlapping windows are buckets; their number a step is bounded, however many delays there are.
    """
    rows = steps.groupBy(F.window("slice_start", width, step)["start"].alias("window_start"), "bucket").agg(*merged())
    return summary(rows, ["window_start"], "latency_ms", quantiles)


def null_tax_ratio(df: DataFrame, tax: str = "tax_amount") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(tax).isNull()).alias("null_tax_count")).select(
        "total_rows", "null_tax_count",
        null_ratio_percent(F.col("null_tax_count"), F.col("total_rows")).alias("null_tax_ratio_percent"))


def current_metrics(
    metrics: DataFrame, commits: Column, lag: Column, latency: Column, checkpoint_duration: Column | None = None,
) -> DataFrame:
    """The one-row metric summary: newest interval plus totals over all intervals.

    ``commits``, ``lag`` and ``latency`` come from the commit log, the backlog and the latency table; ``checkpoint_duration``
    from the progress log (``streaming.progress``), and its column is there only where it is given.
    """
    extra = [] if checkpoint_duration is None else [checkpoint_duration.alias("checkpoint_duration_ms")]
    return metrics.agg(
        F.max_by("throughput", "interval_start").alias("throughput_now"),
        F.max_by("error_rate", "interval_start").alias("error_rate_now"),
        F.sum("incoming").alias("processed_total"),
        F.sum("dlq_count").alias("dlq_count"),
        F.sum("valid_events").alias("valid_events"),
        F.sum("invalid_events").alias("invalid_events"),
    ).select(
        F.col("throughput_now").alias("throughput_events_per_sec"), "processed_total",
        F.col("error_rate_now").alias("error_rate"), "dlq_count",
        commits.alias("checkpoint"), lag.alias("kafka_consumer_lag"), latency.alias("latency_ms"),
        "valid_events", "invalid_events", *extra,
    )
