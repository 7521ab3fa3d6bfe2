"""Batch validation reports. All expectations of a report come out of one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.json_text import with_variant
from sluiceway.operators.rules import Rule, is_valid, wrong_type
from sluiceway.schema import TAX_NOT_NULL_SHARE

# Report texts.
EMPTY_BATCH = "Empty batch received. Skip validation."
AMOUNT_FAILED = "CRITICAL_RULE_FAILED: Negative or zero amounts detected in transaction logs."
TAX_FAILED = "WARNING_THRESHOLD_EXCEEDED: Null tax_amount rate exceeds 10.0%."
SUITE_TAX_FAILED = "tax_amount null ratio exceeded 2% safety threshold."
SUITE_AMOUNT_FAILED = "Negative amount validation failed."
SUITE_NAMES = ("amount > 0", "tax_amount not null > 90%", "schema validation", "Iceberg write contract")


@dataclass(frozen=True)
class Expectation:
    """Counts of one expectation as aggregates: rows looked at, rows without a value, rows that do not fit."""

    name: str
    elements: Column
    missing: Column
    unexpected: Column
    mostly: float
    nulls_fail: bool = False

    def success(self, elements: Column, missing: Column, unexpected: Column) -> Column:
        looked_at = elements if self.nulls_fail else elements - missing
        share = F.try_divide(looked_at - unexpected, looked_at)
        return F.coalesce(share >= self.mostly, F.lit(True))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or not a number in a floating-point column."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def expect_between(
    df: DataFrame, name: str, low=None, high=None, strict_low: bool = False, strict_high: bool = False,
    mostly: float = 1.0,
) -> Expectation:
    """Values inside the bounds; missing values are not looked at."""
    c, out = F.col(name), F.lit(False)
    if low is not None:
        out = out | ((c <= low) if strict_low else (c < low))
    if high is not None:
        out = out | ((c >= high) if strict_high else (c > high))
    missing = is_missing(df, name)
    return Expectation(
        f"{name} between", F.count(F.lit(1)), F.count_if(missing), F.count_if(~missing & out), mostly)


def expect_not_null(df: DataFrame, name: str, mostly: float = 1.0) -> Expectation:
    missing = is_missing(df, name)
    return Expectation(
        f"{name} not null", F.count(F.lit(1)), F.count_if(missing), F.count_if(missing), mostly, nulls_fail=True)


def expect_rule(rule: Rule) -> Expectation:
    """Any rule as an expectation: at least ``mostly`` of the records must not break it."""
    return Expectation(
        rule.name, F.count(F.lit(1)), F.lit(0).cast("bigint"), F.count_if(rule.broken), rule.mostly)


def check(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation, from one pass over the data."""
    aggregates = []
    for i, e in enumerate(expectations):
        aggregates += [e.elements.alias(f"e{i}"), e.missing.alias(f"m{i}"), e.unexpected.alias(f"u{i}")]
    rows = F.array(*[
        F.struct(
            F.lit(e.name).alias("expectation"), F.col(f"e{i}").alias("element_count"),
            F.col(f"m{i}").cast("bigint").alias("missing_count"), F.col(f"u{i}").alias("unexpected_count"),
            e.success(F.col(f"e{i}"), F.col(f"m{i}"), F.col(f"u{i}")).alias("success"))
        for i, e in enumerate(expectations)
    ])
    return df.agg(*aggregates).select(F.inline(rows))


def dq_metrics(df: DataFrame, amount: str = "amount", tax: str = "tax_amount") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows_evaluated"),
        F.count_if(is_missing(df, tax)).alias("null_tax_count"),
        F.count_if(F.col(amount) <= 0).alias("negative_amount_count"),
    )


def validation_report(
    df: DataFrame, timestamp: Column | None = None, amount: str = "amount", tax: str = "tax_amount",
    mostly: float = TAX_NOT_NULL_SHARE, by: Sequence[str] = (),
) -> DataFrame:
    """The two-rule report as one nested row, or one per group with ``by``.

    ``timestamp`` is an aggregate (for instance the newest event time in milliseconds) or a literal.
    A batch without rows gives a warning instead of a verdict.
    """
    first = expect_between(df, amount, low=0, strict_low=True)
    second = expect_not_null(df, tax, mostly)
    stamp = F.lit(None) if timestamp is None else timestamp
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        first.missing.alias("m1"), first.unexpected.alias("u1"),
        second.missing.alias("nulls"),
        F.count_if(F.col(amount) <= 0).alias("not_positive"),
        stamp.cast("bigint").alias("at"),
    )
    n, nulls = F.col("n"), F.col("nulls")
    ok1 = first.success(n, F.col("m1"), F.col("u1"))
    ok2 = second.success(n, nulls, nulls)
    judged = counts.withColumns({"ok1": ok1, "ok2": ok2, "empty": n == 0})
    ok1, ok2, empty = F.col("ok1"), F.col("ok2"), F.col("empty")
    results = F.array(ok1, ok2)
    passed = F.size(F.filter(results, lambda r: r))
    status = (
        F.when(empty, "WARNING").when(~ok1, "ERROR").when(~ok2, "WARNING").otherwise("OK")
    )
    failures = F.array_compact(F.array(F.when(~ok1, AMOUNT_FAILED), F.when(~ok2, TAX_FAILED)))
    return judged.select(
        *by,
        F.col("at").alias("timestamp"),
        status.alias("status"),
        F.when(empty, EMPTY_BATCH).alias("message"),
        F.when(empty, 0).otherwise(F.size(results)).alias("total_assertions"),
        F.when(empty, 0).otherwise(passed).alias("successful_assertions"),
        F.when(empty, 100.0).otherwise(F.round(passed / F.size(results) * 100.0, 2)).alias("success_rate_percent"),
        failures.alias("failures"),
        F.struct(
            n.alias("total_rows_evaluated"), nulls.alias("null_tax_count"),
            F.col("not_positive").alias("negative_amount_count")).alias("metrics"),
    )


def null_ratio_percent(nulls: Column, total: Column) -> Column:
    """Share of nulls in percent, two digits; 0 for no rows."""
    return F.coalesce(F.round(F.try_divide(nulls * 100.0, total), 2), F.lit(0.0))


def expectation_suite(
    routed: DataFrame, contract_kept: Column | None = None, value: str = "value", wrong: str | None = None,
) -> DataFrame:
    """The four-expectation report over routed records, one nested row.

    ``contract_kept`` tells whether every record was written exactly once, as one value; by default each record must
    carry exactly one route. ``wrong`` names a column that says which records have a field of another type; without it the
    text is parsed here.
    """
    routes = F.count_if(F.col("route").isNull()) == 0
    amount, tax = F.col("amount"), F.col("tax_amount")
    good = is_valid(amount, tax)
    judged, mistyped = (routed, F.col(wrong)) if wrong else (with_variant(routed, value, "doc"), wrong_type(F.col("doc")))
    counts = judged.agg(
        F.count(F.lit(1)).alias("total_rows_evaluated"),
        F.count_if(tax.isNull()).alias("null_tax_count"),
        F.count_if(amount <= 0).alias("negative_amount_count"),
        F.count_if(good).alias("valid_events"),
        F.count_if(~good).alias("invalid_events"),
        F.count_if(F.col("breaker_open")).alias("dlq_count"),
        F.count_if(mistyped).alias("wrong_types"),
        routes.alias("kept"),
    )
    if contract_kept is not None:
        counts = counts.withColumn("kept", contract_kept)
    n, nulls = F.col("total_rows_evaluated"), F.col("null_tax_count")
    passed = F.array(
        F.col("negative_amount_count") == 0,
        F.coalesce(F.try_divide(n - nulls, n) >= TAX_NOT_NULL_SHARE, F.lit(True)),
        F.col("wrong_types") == 0,
        F.col("kept"),
    )
    judged = counts.withColumn("passed", passed)
    good_ones = F.size(F.filter("passed", lambda p: p))
    listed = F.array(*[
        F.struct(F.lit(name).alias("expectation"),
                 F.when(F.col("passed")[i], "PASS").otherwise("FAIL").alias("status"))
        for i, name in enumerate(SUITE_NAMES)
    ])
    failures = F.array_compact(F.array(
        F.when(~F.col("passed")[1], SUITE_TAX_FAILED), F.when(~F.col("passed")[0], SUITE_AMOUNT_FAILED)))
    return judged.select(
        F.when(good_ones == len(SUITE_NAMES), "OK").otherwise("ERROR").alias("status"),
        F.lit(len(SUITE_NAMES)).alias("total_assertions"),
        good_ones.alias("successful_assertions"),
        F.round(good_ones / len(SUITE_NAMES) * 100, 1).alias("success_rate_percent"),
        failures.alias("failures"),
        F.struct(
            "total_rows_evaluated", "null_tax_count",
            null_ratio_percent(nulls, n).alias("null_tax_ratio_percent"),
            "negative_amount_count", "valid_events", "invalid_events", "dlq_count").alias("metrics"),
        listed.alias("expectations"),
    )
