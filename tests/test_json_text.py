"""JSON edge cases of the anomaly flag, the diversion keys and the typed parser."""

import json

import pytest
from pyspark.sql import functions as F

from sluiceway.functions import json_text

# text, anomaly, what happens to it in the dead-letter table
EDGES = [
    ('{"tax_amount":null}', True, "annotated"),
    ('{"a":1}', False, "annotated"),
    ("{bad", True, "unchanged"),
    ("", False, "unchanged"),
    ("  ", False, "unchanged"),
    ("\t\r\n", False, "unchanged"),
    ("123", False, "unchanged"),
    ("[1]", False, "unchanged"),
    ('"s"', False, "unchanged"),
    ("null", False, "unchanged"),
    ('{"a":1} t', False, "annotated"),
    ('{"tax_amount":1,"tax_amount":null}', True, "annotated"),
    ('{"tax_amount":null,"tax_amount":1}', False, "annotated"),
    ("{'tax_amount':null}", True, "unchanged"),
    ('{"tax_amount":NaN}', True, "unchanged"),
    ('{"x":{"tax_amount":null}}', False, "annotated"),
    ('{"Tax_Amount":null}', False, "annotated"),
    ('{"tax_amount":"null"}', False, "annotated"),
    ('"{not an object"', False, "unchanged"),
    (' {"a":"}","b":"\\"x\\u00e9"}', False, "annotated"),
    ("{}", False, "annotated"),
    ('{"anomaly_status":"old","error_rate":7,"deep":{"k":[1,null,{"z":12345678901234567890.12}]}}', False, "annotated"),
    (None, True, "null"),
]


@pytest.fixture(scope="module")
def edges(spark):
    df = spark.createDataFrame([(i, e[0]) for i, e in enumerate(EDGES)], "id int, value string")
    out = json_text.flag_anomalies(df).withColumn("text", json_text.annotate(F.col("value"), F.lit(0.25)))
    return {r["id"]: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(EDGES)))
def test_edge(edges, i):
    text, bad, fate = EDGES[i]
    row = edges[i]
    assert row["bad"] is bad
    if fate != "annotated":
        assert row["text"] == text
        return
    expected = json.JSONDecoder().raw_decode(text.lstrip())[0]
    expected.update(anomaly_status="DIVERTED", anomaly_reason="NULL_TAX_AMOUNT", error_rate=0.25)
    assert json.loads(row["text"]) == expected


def test_valid_json(spark):
    df = spark.createDataFrame([(e[0],) for e in EDGES], "value string")
    got = [r[0] for r in df.select(json_text.is_valid_json(F.col("value"))).collect()]
    broken = {"{bad", "{'tax_amount':null}", '{"tax_amount":NaN}', None}
    assert got == [e[0] not in broken for e in EDGES]


def test_decode_replaces_bytes_that_are_not_utf8(spark):
    df = spark.createDataFrame([(bytearray("é".encode()), 0, 7), (bytearray(b"a\xffb"), 0, 8), (None, 0, 9)],
                               "value binary, partition int, offset bigint")
    got = {r["offset"]: r["value"] for r in json_text.decode_value(df).collect()}
    assert got == {7: "é", 8: "a�b", 9: None}


TRANSACTION = {
    "transactionId": "string", "userId": "string", "productId": "string", "quantity": "int", "price": "double",
    "taxAmount": "double", "paymentMethod": "string", "eventTimestamp": "string",
}


def test_typed_record(spark):
    texts = [
        '{"transactionId":"t1","quantity":2,"price":9.5,"taxAmount":0.7}',
        '{"transactionId":"t2","quantity":null,"taxAmount":null}',
        '{"transactionId":"t3","unknown":1}',
        '{"transactionId":"t4","price":"abc"}',
        '{"transactionId":{"nested":1}}',
        "{broken",
        "[1]",
        "",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    out = json_text.parse_typed(df, TRANSACTION, {"quantity": 0, "price": 0.0})
    got = {r["id"]: r["record"] for r in out.collect()}
    assert got[0]["transactionId"] == "t1" and got[0]["quantity"] == 2 and got[0]["price"] == 9.5
    # Absent or null primitives take their default, the boxed member stays null.
    assert got[1]["quantity"] == 0 and got[1]["price"] == 0.0 and got[1]["taxAmount"] is None
    assert all(got[i] is None for i in range(2, 9))


def test_json_text_writes_nulls_and_empty_object(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', CAST(NULL AS STRING)) AS r UNION ALL SELECT NULL")
    got = sorted(r[0] for r in df.select(json_text.to_json_text(F.col("r"))).collect())
    assert got == ['{"a":1,"b":null}', "{}"]


def test_unexpected_keys(spark):
    df = spark.createDataFrame([('{"b":1,"z":2,"a":3}',), ("{bad",), ("[1]",), ('{"a":1}',)], "value string")
    out = json_text.with_variant(df).select(json_text.unexpected_keys(F.col("doc"), ["a"]).alias("k"))
    assert [r["k"] for r in out.collect()] == [["b", "z"], [], [], []]
