"""Breaker boundaries, and running sums against a plain loop on skewed data."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.operators import breaker, incidents
from sluiceway.operators.running import plan_cuts, running_sums, slice_rows

MAIN, DLQ = "ecommerce_events", "ecommerce_events_dlq"


def frame(spark, flags):
    rows = [(i, i, bool(f)) for i, f in enumerate(flags)]
    return spark.createDataFrame(rows, "event_id bigint, at bigint, bad boolean").select(
        "event_id", F.timestamp_seconds("at").alias("event_ts"), "bad")


def routes(spark, flags, **options):
    rows = breaker.circuit_breaker(frame(spark, flags), **options).orderBy("event_id").collect()
    return [r["route"] for r in rows]


@pytest.mark.parametrize("flags,expected", [
    ([1] * 49, [MAIN] * 49),
    ([0] * 49 + [1], [MAIN] * 50),
    ([0] * 48 + [1, 1], [MAIN] * 49 + [DLQ]),
    ([0] * 48 + [1, 1] + [0] * 60, [MAIN] * 49 + [DLQ] * 50 + [MAIN] * 11),
])
def test_boundaries(spark, flags, expected):
    assert routes(spark, flags) == expected


def test_carry_continues_the_counters(spark):
    flags = [0] * 48 + [1, 1] + [0] * 60
    whole = routes(spark, flags)
    tail = routes(spark, flags[50:], carry={"total": 50, "failed": 2})
    assert tail == whole[50:]


def test_empty_input(spark):
    assert breaker.circuit_breaker(frame(spark, [0]).where("event_id > 5")).collect() == []


def test_incidents_pair_openings_with_closings(spark):
    rng = random.Random(4)
    flags = [rng.random() < 0.02 for _ in range(6000)]
    routed = breaker.circuit_breaker(frame(spark, flags))
    total = failed = 0
    opened, expected = None, []
    for i, f in enumerate(flags):
        total, failed = total + 1, failed + f
        now = total >= 50 and failed / total > 0.02
        if now and opened is None:
            opened = i
        elif not now and opened is not None:
            expected.append((f"INC-{opened * 1_000_000}-{opened}", opened, i))
            opened = None
    if opened is not None:
        expected.append((f"INC-{opened * 1_000_000}-{opened}", opened, None))
    assert len(expected) > 5
    got = incidents.breaker_incidents(breaker.transitions(routed)).select(
        "incident_id", F.unix_seconds("opened_at"), F.unix_seconds("resolved_at"), "resolved").collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(expected)
    assert all(r["resolved"] == (r[2] is not None) for r in got)


def expected_sums(rows, keyed=False):
    """rows: (key, time or None, id, flag); nulls come first."""
    out, totals = {}, {}
    for key, at, ident, flag in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        k = key if keyed else 0
        n, s = totals.get(k, (0, 0))
        totals[k] = out[ident] = (n + 1, s + flag)
    return out


def sums_of(spark, rows, key=(), **options):
    df = spark.createDataFrame(rows, "key string, at bigint, event_id bigint, flag int")
    out = running_sums(df, {"n": F.lit(1), "s": F.col("flag")}, ["at", "event_id"], key, **options)
    assert set(out.columns) == {"key", "at", "event_id", "flag", "n", "s"}
    return {r["event_id"]: (r["n"], r["s"]) for r in out.collect()}


def skewed_rows(count, seed=1):
    """A third of the rows share one time, some have none, one lies far off; one key holds a third."""
    rng = random.Random(seed)
    ids = rng.sample(range(count * 10), count)
    rows = []
    for ident in ids:
        x = rng.random()
        at = 777 if x < 0.33 else None if x < 0.4 else rng.randrange(1_000_000)
        key = "hot" if rng.random() < 0.34 else None if rng.random() < 0.1 else f"k{rng.randrange(60)}"
        rows.append((key, at, ident, rng.randrange(2)))
    rows.append(("far", 10**15, count * 10 + 1, 1))
    return rows


def test_skewed_order(spark):
    rows = skewed_rows(3000)
    assert sums_of(spark, rows, rows_per_slice=47) == expected_sums(rows)


def test_slices_stay_small_when_one_time_holds_a_third(spark):
    rows = skewed_rows(6000)
    df = spark.createDataFrame(rows, "key string, at bigint, event_id bigint, flag int")
    cut, columns = slice_rows(df, ["at", "event_id"], 94)
    assert len(columns) > 1
    biggest = cut.groupBy(*columns).count().agg(F.max("count")).first()[0]
    assert biggest <= 4 * 94


def test_skewed_keys(spark):
    rows = skewed_rows(3000, seed=2)
    assert sums_of(spark, rows, key=["key"], rows_per_slice=188) == expected_sums(rows, keyed=True)


def test_no_hot_keys(spark):
    rows = [(f"k{i % 50}", i // 3, i, i % 2) for i in range(500)]
    assert sums_of(spark, rows, key=["key"], rows_per_slice=63) == expected_sums(rows, keyed=True)


def test_more_slices_than_shuffle_partitions(spark):
    rows = skewed_rows(2000, seed=3)
    assert sums_of(spark, rows, rows_per_slice=10) == expected_sums(rows)


def test_cuts_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(skewed_rows(1000), "key string, at bigint, event_id bigint, flag int")
    one = plan_cuts(df.repartition(1), ["at", "event_id"], 63)
    many = plan_cuts(df.repartition(13), ["at", "event_id"], 63)
    assert [sorted(level) for level in one.levels] == [sorted(level) for level in many.levels]


def test_whole_range_of_numbers(spark):
    rng = random.Random(5)
    times = [-(2**63), 2**63 - 1, 2**62, -(2**62), 0, 1, 2, None] + [rng.randrange(-(2**63), 2**63) for _ in range(300)]
    rows = [("a", at, i, i % 2) for i, at in enumerate(times)]
    assert sums_of(spark, rows, rows_per_slice=8) == expected_sums(rows)


def test_three_order_columns(spark):
    """Broker order: most messages carry the same time, partitions interleave."""
    rng = random.Random(6)
    rows = [(7 if rng.random() < 0.8 else rng.randrange(20), i % 3, i // 3, rng.randrange(2)) for i in range(2000)]
    expected, n, s = {}, 0, 0
    for t, p, o, f in sorted(rows):
        n, s = n + 1, s + f
        expected[(p, o)] = (n, s)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "t bigint, partition int, offset bigint, flag int").withColumn(
        "timestamp", F.timestamp_seconds("t"))
    out = running_sums(df, {"n": F.lit(1), "s": F.col("flag")}, ["timestamp", "partition", "offset"], rows_per_slice=32)
    assert {(r["partition"], r["offset"]): (r["n"], r["s"]) for r in out.collect()} == expected


def test_missing_flags_count_as_good(spark):
    df = frame(spark, [1, 0, 1]).withColumn("bad", F.when(F.col("event_id") > 0, F.col("bad")))
    assert [r["failed"] for r in breaker.circuit_breaker(df).orderBy("event_id").collect()] == [0, 0, 1]


def test_text_cannot_order(spark):
    with pytest.raises(TypeError):
        plan_cuts(spark.createDataFrame([("a",)], "t string"), ["t"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5)), st.integers(0, 1)),
             min_size=1, max_size=80),
    st.integers(1, 20),
)
def test_any_order_and_slice_size(spark, triples, size):
    rows = [(k, at, i, f) for i, (k, at, f) in enumerate(triples)]
    assert sums_of(spark, rows, rows_per_slice=size) == expected_sums(rows)
    assert sums_of(spark, rows, key=["key"], rows_per_slice=size) == expected_sums(rows, keyed=True)
