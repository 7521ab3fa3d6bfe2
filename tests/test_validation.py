"""Golden reports of the validator and single expectations."""

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import validation as v
from sluiceway.schema import VALIDATOR_BATCH


def batch(spark, amounts_bad=0, tax_null=0, rows=100, nan=False):
    data = []
    for i in range(rows):
        amount = -10.0 if i < amounts_bad else 20.0 + i
        tax = (float("nan") if nan else None) if i >= rows - tax_null else round(amount * 0.08, 2)
        data.append((f"ORD-{100000 + i}", f"USR-{5000 + i}", amount, tax, "COMPLETED", 1_700_000_000_000 + i))
    return spark.createDataFrame(data, VALIDATOR_BATCH)


def report(df):
    return v.validation_report(df, F.max("timestamp")).first()


@pytest.mark.parametrize("bad,nulls,nan,status,passed,rate,failures", [
    (0, 0, False, "OK", 2, 100.0, []),
    (5, 15, False, "ERROR", 0, 0.0, [v.AMOUNT_FAILED, v.TAX_FAILED]),
    (0, 11, False, "WARNING", 1, 50.0, [v.TAX_FAILED]),
    (0, 10, False, "OK", 2, 100.0, []),
    (0, 11, True, "WARNING", 1, 50.0, [v.TAX_FAILED]),
    (1, 0, False, "ERROR", 1, 50.0, [v.AMOUNT_FAILED]),
])
def test_report(spark, bad, nulls, nan, status, passed, rate, failures):
    r = report(batch(spark, bad, nulls, nan=nan))
    assert (r["status"], r["total_assertions"], r["successful_assertions"]) == (status, 2, passed)
    assert r["success_rate_percent"] == rate and r["failures"] == failures and r["message"] is None
    assert tuple(r["metrics"]) == (100, nulls, bad)
    assert r["timestamp"] == 1_700_000_000_099


def test_empty_batch(spark):
    r = report(batch(spark, rows=0))
    assert (r["status"], r["message"], r["success_rate_percent"]) == ("WARNING", v.EMPTY_BATCH, 100.0)
    assert r["failures"] == [] and tuple(r["metrics"]) == (0, 0, 0)


def test_zero_amount_fails_the_strict_minimum_only(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "amount double")
    strict, loose = v.check(df, [
        v.expect_between(df, "amount", low=0, strict_low=True), v.expect_between(df, "amount", low=0),
    ]).collect()
    assert (strict["missing_count"], strict["unexpected_count"], strict["success"]) == (1, 1, False)
    assert (loose["unexpected_count"], loose["success"]) == (0, True)


def test_upper_bound_and_mostly(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "amount double")
    rows = v.check(df, [
        v.expect_between(df, "amount", high=9, strict_high=True, mostly=0.9),
        v.expect_between(df, "amount", high=8, strict_high=True, mostly=0.9),
    ]).collect()
    assert [r["success"] for r in rows] == [True, False]


def test_only_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "amount double")
    between, present = v.check(df, [v.expect_between(df, "amount", low=0), v.expect_not_null(df, "amount", 0.9)]).collect()
    assert between["success"] is True and present["success"] is False
