"""A mergeable histogram of whole numbers, for quantiles whose state does not grow with the number of different values.

A value falls into the bucket of its ``bits`` leading binary digits and its sign. Values of one bucket differ by less than
2 ** (1 - bits) of themselves, and there are at most 2 * 64 * 2 ** (bits - 1) buckets, whatever the values. A bucket keeps how
many there were, their sum, the least and the largest; histograms are merged by adding, and by the least and the largest.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 7
_LARGEST = 2**63 - 1


def bucket_of(value: Column, bits: int = BITS) -> Column:
    """The bucket of a whole number: its magnitude with all but the leading ``bits`` digits zero, and its sign. Null stays null."""
    size = F.abs(F.greatest(value.cast("bigint"), F.lit(-_LARGEST)))
    cut = F.greatest(F.length(F.bin(size)) - bits, F.lit(0))
    kept = F.call_function("shiftleft", F.call_function("shiftright", size, cut), cut)
    return F.when(value < 0, -kept).otherwise(kept)


def merged() -> list[Column]:
    """Aggregates that merge histogram rows of the same bucket."""
    return [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")]


def histogram(df: DataFrame, value: str, by: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """Per group of ``by`` and bucket: ``n``, ``total``, ``low`` and ``high``. Null values are in no bucket."""
    whole = df.select(*by, F.col(value).cast("bigint").alias("low")).where(F.col("low").isNotNull())
    rows = whole.withColumns({"bucket": bucket_of(F.col("low"), bits), "n": F.lit(1).cast("bigint"), "total": F.col("low"), "high": F.col("low")})
    return rows.groupBy(*by, "bucket").agg(*merged())


def quantile_name(q: float, name: str) -> str:
    return f"p{Decimal(str(q)) * 100:f}".rstrip("0").rstrip(".").replace(".", "_") + f"_{name}"


def summary(rows: DataFrame, by: Sequence[str], name: str, quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Count, exact mean and maximum, and estimated quantiles per group, out of merged histogram rows (one per group and bucket).

    A quantile q is the value of rank ceil(q * n). Its estimate lies in the same bucket, half way between the least and the
    largest value there, so it is off by less than 2 ** -bits of the true value, and not at all where the bucket holds one value.
    The window runs over a group's buckets, whose number is bounded.
    """
    every = Window.partitionBy(*by)
    counted = rows.withColumns({"__seen": F.sum("n").over(every.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                                "__all": F.sum("n").over(every), "__middle": (F.col("low") + F.col("high")) / 2})
    found = [F.min(F.when(F.col("__seen") >= F.ceil(F.col("__all") * F.lit(Decimal(str(q)))), F.col("__middle"))).alias(quantile_name(q, name))
             for q in quantiles]
    return counted.groupBy(*by).agg(
        F.sum("n").alias("records"), (F.sum("total") / F.sum("n")).alias(f"avg_{name}"), F.max("high").alias(f"max_{name}"), *found)
