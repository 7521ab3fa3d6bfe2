"""Reports on disk, CSV, reconciliation, commit log, scalars."""

import datetime

import pytest
from pyspark.sql import functions as F

from sluiceway.functions import scalars
from sluiceway.operators import incidents, ledger, metrics, rules
from sluiceway.operators.validation import validation_report
from sluiceway.sources import readers, writers


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "event_id bigint")


def test_contract_kept(spark):
    row = ledger.write_contract(ids(spark, 1, 2, 3), ids(spark, 1, 3), ids(spark, 2)).first()
    assert tuple(row) == (3, 2, 1, 0, 0, 0, "PASS")


def test_contract_broken(spark):
    row = ledger.write_contract(ids(spark, 1, 2, 3, 4), ids(spark, 1, 1, 9), ids(spark, 2, 1)).first()
    assert (row["missing"], row["duplicated"], row["unexpected"], row["contract"]) == (2, 2, 1, "FAIL")


def test_contract_of_nothing(spark):
    none = ids(spark, 1).where("event_id = 2")
    assert tuple(ledger.write_contract(none, none, none).first()) == (0, 0, 0, 0, 0, 0, "PASS")


def test_backlog_by_partition(spark):
    source = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "event_id bigint, src_partition int")
    got = {r[0]: r[1] for r in ledger.backlog(source, ids(spark, 2), by="src_partition").collect()}
    assert got == {0: 1, 1: 1}


def test_live_backlog():
    progress = {"sources": [{"latestOffset": '{"t":{"0":10,"1":7}}', "endOffset": {"t": {"0": 4, "1": 7}}}]}
    assert ledger.live_backlog(progress) == 6


def test_csv_batch(spark, folder):
    lines = ["transaction_id,user_id,amount,tax_amount,timestamp"]
    for i in range(100):
        ident = 6626 if i in (15, 18) else 8133 if i in (49, 96) else 1000 + i
        lines.append(f"{ident},U{i},{142 + i},{(142 + i) * 0.18:.2f},2024-05-01 10:00:00.{i:06d}")
    with open(f"{folder}/t.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    df = readers.read_csv_batch(spark, f"{folder}/t.csv")
    assert df.count() == 100
    amount = F.col("amount")
    wrong = df.where(F.abs(F.col("tax_amount") - scalars.expected_tax(amount, 0.18).cast("double")) > 0.001)
    assert wrong.isEmpty()
    assert {r[0]: r[1] for r in ledger.duplicate_keys(df, "transaction_id").collect()} == {6626: 2, 8133: 2}
    canonical = readers.from_transactions_csv(df).where("order_id = '1001'").first()
    assert canonical["event_ts"] == datetime.datetime(2024, 5, 1, 10, 0, 0, 1) and canonical["currency"] is None


def test_report_files(spark, folder):
    df = spark.createDataFrame([(1.0, 0.1)], "amount double, tax_amount double")
    computed = validation_report(df, F.lit(5))
    assert readers.read_report(spark, f"{folder}/absent").count() == 0
    writers.save_report(computed.withColumn("timestamp", F.lit(7).cast("bigint")), f"{folder}/r", f"{folder}/h")
    writers.save_report(computed.withColumn("timestamp", F.lit(9).cast("bigint")), f"{folder}/r", f"{folder}/h")
    assert readers.report_with_fallback(readers.read_report(spark, f"{folder}/r"), computed).first()["timestamp"] == 9
    assert spark.read.parquet(f"{folder}/h").count() == 2
    with open(f"{folder}/broken.json", "w") as f:
        f.write("{not json")
    broken = readers.read_report(spark, f"{folder}/broken.json")
    assert readers.report_with_fallback(broken, computed).first()["timestamp"] == 5


def test_indented_report_can_be_read(spark, folder):
    with open(f"{folder}/r.json", "w") as f:
        f.write('{\n  "timestamp": 3,\n  "status": "OK",\n  "failures": []\n}\n')
    row = readers.read_report(spark, f"{folder}/r.json").first()
    assert (row["timestamp"], row["status"], row["failures"]) == (3, "OK", [])


def test_rewriting_a_batch_replaces_it(spark, folder):
    df = spark.createDataFrame([(1, "ecommerce_events"), (2, "ecommerce_events_dlq")], "event_id bigint, route string")
    writers.write_routed(df, folder, 0)
    writers.write_routed(df, folder, 1)
    writers.write_routed(df.where("event_id = 1"), folder, 1)
    rows = writers.read_routed(spark, folder, df.schema).select("batch_id", "event_id").collect()
    assert sorted(tuple(r) for r in rows) == [(0, 1), (0, 2), (1, 1)]
    writers.write_routed(df.where("event_id = 9"), folder, 1)
    assert writers.read_routed(spark, folder, df.schema).count() == 2
    assert [r["event_id"] for r in writers.read_dlq(spark, folder, df.schema).collect()] == [2]


@pytest.mark.parametrize("text,expected", [
    ("2024-01-02T03:04:05.678+00:00", datetime.datetime(2024, 1, 2, 3, 4, 5, 678000)),
    ("2024-01-02T05:04:05.678+02:00", datetime.datetime(2024, 1, 2, 3, 4, 5, 678000)),
    ("2024-01-02 03:04:05.000001", datetime.datetime(2024, 1, 2, 3, 4, 5, 1)),
    ("1704164645678", datetime.datetime(2024, 1, 2, 3, 4, 5, 678000)),
    ("yesterday-ish", None),
    (None, None),
])
def test_time_formats(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(F.date_format(scalars.normalize_time(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    assert got == (expected.strftime("%Y-%m-%d %H:%M:%S.%f") if expected else None)


def test_metric_fields(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(scalars.metric_number(F.col("t"))).collect()] == [1.5, 0.0, 0.0]
    df = spark.createDataFrame([(-1.0,), (55.5,), (101.0,)], "x double")
    assert [r[0] for r in df.select(scalars.clamp_percent(F.col("x"))).collect()] == [0.0, 55.5, 100.0]


def test_null_ratio_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1.0,)], "tax_amount double").where("tax_amount > 2")
    assert tuple(metrics.null_tax_ratio(df).first()) == (0, 0, 0.0)


def test_canonical_rejects_other_names(spark):
    with pytest.raises(ValueError):
        readers.canonicalize(ids(spark, 1), {"nope": F.col("event_id")})


def test_custom_rules(spark):
    df = spark.createDataFrame([(1, "x", '{"a":1}'), (2, "y", "{")], "n int, s string, value string")
    out = rules.record_failures(df, [rules.Rule("odd", F.col("n") % 2 == 1), rules.Rule("y", F.col("s") == "y")])
    assert [r["failure_reasons"] for r in out.orderBy("n").collect()] == [["odd"], ["y"]]


def test_incident_lists(spark):
    rows = [(f"INC-{i}", datetime.datetime(2024, 1, 1, i), i % 2 == 0) for i in range(8)]
    df = spark.createDataFrame(rows, "incident_id string, opened_at timestamp, resolved boolean")
    assert [r["incident_id"] for r in incidents.latest(df).collect()] == [f"INC-{i}" for i in (7, 6, 5, 4, 3)]
    assert incidents.active(df).count() == 4
    assert incidents.deduplicated(df.unionByName(df)).count() == 8


def test_wrong_types(spark):
    texts = ['{"amount":1,"tax_amount":0.5,"order_id":"x"}', '{"amount":1e300}', '{"amount":null,"order_id":null}', "{}",
             '{"amount":"1"}', '{"order_id":7}', '{"order_id":{"a":1}}', '{"amount":[1]}', '{"amount":true}', "{bad"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    doc = F.try_parse_json("value")
    got = [r[0] for r in df.orderBy("id").select(rules.wrong_type(doc)).collect()]
    assert got == [False] * 4 + [True] * 5 + [False]


def test_numeric_and_required_fields(spark):
    texts = ['{"amount":1.25}', '{"amount":"1.25"}', '{"amount":null}', '{"amount":"abc"}', '{"amount":{}}', "{}", "{bad", "[1]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string").orderBy("id")
    doc = F.try_parse_json("value")
    rows = df.select(rules.not_numeric(doc, "amount"), rules.missing_field(doc, "amount")).collect()
    assert [r[0] for r in rows] == [False, False, False, True, True, False, False, False]
    assert [r[1] for r in rows] == [False, False, True, False, False, True, False, True]
