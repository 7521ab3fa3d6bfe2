"""Event-time windows as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(
    flagged: DataFrame,
    width: str = "1 minute",
    step: str | None = None,
    lateness: str = "10 minutes",
    ts: str = "event_ts",
    flag: str = "bad",
) -> DataFrame:
    """Records and flagged records per tumbling or sliding window; rows later than ``lateness`` are not counted.

    In append mode a window comes out once the watermark has passed its end.
    """
    window = F.window(ts, width, step) if step else F.window(ts, width)
    return (
        flagged.withWatermark(ts, lateness)
        .groupBy(window.alias("w"))
        .agg(F.count(F.lit(1)).alias("records"), F.count_if(flag).alias("flagged"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "records", "flagged")
    )
