"""Small scalar helpers: time formats, tax, metric fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluiceway.schema import TAX_RATE


def normalize_time(text: Column) -> Column:
    """Epoch milliseconds, ISO-8601 text or plain timestamp text to a timestamp; NULL if none fits."""
    text = text.cast("string")
    return F.coalesce(F.timestamp_millis(text.try_cast("bigint")), text.try_cast("timestamp"))


def expected_tax(amount: Column, rate: float | Column = TAX_RATE) -> Column:
    """Tax on a positive amount, zero otherwise, in cents."""
    rate = F.lit(str(rate)).cast("decimal(6,4)") if isinstance(rate, float) else rate
    return F.when(amount > 0, (amount * rate).cast("decimal(18,2)")).otherwise(F.lit(0).cast("decimal(18,2)"))


def metric_number(x: Column) -> Column:
    """A metric field as number; absent, null or unreadable counts as 0."""
    return F.coalesce(x.try_cast("double"), F.lit(0.0))


def clamp_percent(x: Column) -> Column:
    return F.greatest(F.lit(0).cast("double"), F.least(F.lit(100).cast("double"), x.cast("double")))
