"""Every operator as a named query over the ``events`` table of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions import json_text, scalars
from sluiceway.operators import breaker, incidents, ledger, metrics, rules, validation
from sluiceway.plans.checkout import checkout_events
from sluiceway.schema import MINIMUM_RECORDS
from sluiceway.session import fresh_path
from sluiceway.sources import readers, writers
from sluiceway.streaming import job, pipeline, progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAGED = "event_id bigint, event_ts timestamp, value string"
TYPED_FIELDS = {
    "order_id": "string", "user_id": "string", "amount": "decimal(18,2)", "tax_amount": "decimal(18,2)",
    "currency": "string", "country": "string", "payment_method": "string",
}


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


# Shared inputs.

def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_text.flag_anomalies(checkout_events(spark, sf_dir))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_text.with_variant(checkout_events(spark, sf_dir))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker.circuit_breaker(flagged(spark, sf_dir))


def money(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def clock(column: str | Column, name: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)


def slice_of(ts: str = "event_ts") -> Column:
    """Arrival slice of an event: first, second or last ten days of its month."""
    day = F.dayofmonth(ts)
    return F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2)


# Sources and sinks.

@query
def stream_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "stream-source")
    checkout_events(spark, sf_dir).select("event_id", F.col("event_ts").cast("timestamp"), "value").write.parquet(
        f"{root}/inbox")
    events = readers.read_events(spark, "parquet", spark.read.parquet(f"{root}/inbox").schema, path=f"{root}/inbox")
    events.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(
        f"{root}/out", format="parquet").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", "value")


@query
def decode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = checkout_events(spark, sf_dir).select(
        F.encode("order_id", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("event_ts").alias("timestamp"))
    return json_text.decode_value(messages).select("partition", F.col("offset").alias("event_id"), "value")


@query
def read_json_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json-batch")
    checkout_events(spark, sf_dir).select(
        "order_id", F.col("user_key").alias("user_id"), "amount", "tax_amount", F.lit("COMPLETED").alias("status"),
        F.unix_millis(F.col("event_ts").cast("timestamp")).alias("timestamp")).write.json(path)
    return readers.read_json_batch(spark, path)


@query
def read_csv_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "csv-batch")
    checkout_events(spark, sf_dir).select(
        F.col("order_no").alias("transaction_id"), F.concat(F.lit("U"), F.col("user_id")).alias("user_id"),
        "amount", "tax_amount", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
    ).write.option("header", True).csv(path)
    return readers.read_csv_batch(spark, path).withColumn("amount", money("amount"))


def _written(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    root = fresh_path(spark, "routed")
    out = breaker.annotate_diverted(routed(spark, sf_dir)).select(
        "event_id", "event_ts", "total", "failed", "error_rate", "breaker_open", "value", "route")
    writers.write_routed(out, root)
    return root, out


@query
def write_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, out = _written(spark, sf_dir)
    return writers.read_main(spark, root, out.schema).select("event_id", "total", "failed", "value")


@query
def write_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, out = _written(spark, sf_dir)
    dlq = json_text.with_variant(writers.read_dlq(spark, root, out.schema))
    return dlq.select(
        "event_id", "total", "failed",
        F.try_variant_get("doc", "$.anomaly_status", "string").alias("anomaly_status"),
        F.try_variant_get("doc", "$.error_rate", "double").alias("error_rate"))


@query
def topic_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.topic_payloads(
        checkout_events(spark, sf_dir), ~rules.is_valid(F.col("amount"), F.col("tax_amount")))


@query
def keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = checkout_events(spark, sf_dir).select(
        "order_id", F.col("user_key").alias("user_id"), "amount", "tax_amount", "currency", "country",
        "payment_method")
    return writers.keyed_json(record)


def _newest_millis() -> Column:
    return F.unix_millis(F.max(F.col("event_ts").cast("timestamp")))


def _flat_report(report: DataFrame, *extra: str) -> DataFrame:
    return report.select(
        *extra, "timestamp", "status", "message", "total_assertions", "successful_assertions",
        "success_rate_percent", F.array_join("failures", "|").alias("failures"), "metrics.*")


@query
def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "report")
    report = validation.validation_report(checkout_events(spark, sf_dir), _newest_millis())
    writers.save_report(report, f"{path}/latest", f"{path}/history")
    return _flat_report(readers.read_report(spark, f"{path}/latest"))


@query
def report_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table's report when the saved one is absent, broken, and readable (its status then differs)."""
    path = fresh_path(spark, "report")
    computed = validation.validation_report(checkout_events(spark, sf_dir), _newest_millis()).checkpoint()
    writers.save_report(computed.withColumn("status", F.lit("SAVED")), f"{path}/saved")
    computed.select(F.concat(F.lit("{broken "), F.col("status"))).write.text(f"{path}/broken")
    cases = [
        readers.report_with_fallback(readers.read_report(spark, f"{path}/{case}"), computed)
        .withColumn("case", F.lit(case)) for case in ("absent", "broken", "saved")
    ]
    return _flat_report(cases[0].unionByName(cases[1]).unionByName(cases[2]), "case")


# Projection, parsing, scalars.

@query
def parse_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = json_text.parse_typed(checkout_events(spark, sf_dir), TYPED_FIELDS)
    return typed.select(
        "event_id", F.col("record").isNotNull().alias("parsed"), F.col("record.order_id").alias("order_id"),
        F.col("record.amount").cast("double").alias("amount"),
        F.col("record.tax_amount").cast("double").alias("tax_amount"), F.col("record.currency").alias("currency"))


def _transaction() -> Column:
    return F.struct(
        F.col("order_id").alias("transactionId"), F.col("user_key").alias("userId"),
        F.lit(None).cast("string").alias("productId"), F.lit(1).alias("quantity"), F.col("amount").alias("price"),
        F.col("tax_amount").alias("taxAmount"), F.col("payment_method").alias("paymentMethod"),
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("eventTimestamp"))


@query
def to_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkout_events(spark, sf_dir).select("event_id", json_text.to_json_text(_transaction()).alias("json"))


@query
def valid_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkout_events(spark, sf_dir).select("event_id", json_text.is_valid_json(F.col("value")).alias("valid"))


@query
def null_tax_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).select("event_id", json_text.is_null_field(F.col("doc"), "tax_amount").alias("null_tax"))


@query
def annotate_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only diverted records are judged and annotated, from one parse."""
    diverted = json_text.with_variant(breaker.circuit_breaker(flagged(spark, sf_dir)).where("breaker_open"))
    judged = rules.judge(diverted, rules.checkout_rules())
    annotated = judged.withColumn("value", json_text.annotate_document(F.col("doc"), F.col("value"), F.col("error_rate")))
    doc = F.col("doc")
    return json_text.with_variant(annotated.drop("doc")).select(
        "event_id",
        F.try_variant_get(doc, "$.order_id", "string").alias("order_id"),
        F.try_variant_get(doc, "$.anomaly_status", "string").alias("anomaly_status"),
        F.try_variant_get(doc, "$.anomaly_reason", "string").alias("anomaly_reason"),
        F.try_variant_get(doc, "$.error_rate", "double").alias("error_rate"),
        F.size(F.map_keys(json_text.as_object(doc))).cast("bigint").alias("key_count"),
        F.array_join("failure_reasons", "|").alias("failure_reasons"))


@query
def canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table in each of the four record shapes, brought to the one canonical shape."""
    base = checkout_events(spark, sf_dir)
    typed_stamp = F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    shapes = {
        "generator": readers.from_generator_json(base),
        "transaction": readers.from_transaction(base.select(_transaction().alias("record"))),
        "validator": readers.from_validator_batch(base.select(
            "order_id", F.col("user_key").alias("user_id"), money("amount"), money("tax_amount"),
            F.lit("COMPLETED").alias("status"), F.unix_millis(F.col("event_ts").cast("timestamp")).alias("timestamp"))),
        "csv": readers.from_transactions_csv(base.select(
            F.col("order_no").alias("transaction_id"), F.concat(F.lit("U"), F.col("user_id")).alias("user_id"),
            "amount", money("tax_amount"), typed_stamp.alias("timestamp"))),
    }
    out = None
    for name, frame in shapes.items():
        part = frame.withColumn("shape", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(
        "shape", "order_id", "user_id", money("amount"), money("tax_amount"), "currency", "country", "payment_method",
        "status", F.col("quantity").cast("bigint").alias("quantity"), F.unix_micros("event_ts").alias("event_micros"))


@query
def normalize_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("event_ts")
    texts = checkout_events(spark, sf_dir).select(
        "event_id",
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("iso"),
        F.unix_millis(ts.cast("timestamp")).cast("string").alias("millis"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("plain"))
    return texts.select(
        "event_id", *[F.unix_micros(scalars.normalize_time(F.col(c))).alias(f"{c}_micros") for c in ("iso", "millis", "plain")])


@query
def expected_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("amount")
    return checkout_events(spark, sf_dir).select(
        "event_id", scalars.expected_tax(amount).cast("double").alias("tax_8"),
        scalars.expected_tax(amount, 0.18).cast("double").alias("tax_18"))


@query
def metric_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read(name: str) -> Column:
        return scalars.metric_number(F.try_variant_get("doc", f"$.{name}", "string")).alias(name)

    return parsed(spark, sf_dir).select("event_id", read("amount"), read("tax_amount"))


@query
def clamp_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkout_events(spark, sf_dir).select("event_id", scalars.clamp_percent(F.col("amount")).alias("percent"))


# Rules.

def _rule(name: str, make: Callable[[], dict[str, Column]]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return parsed(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in make().items()])

    run.__name__ = name
    query(run)


_rule("rule_null_tax", lambda: {"broken": rules.null_tax(F.col("tax_amount"))})
_rule("rule_negative_amount", lambda: {"broken": rules.negative_amount(F.col("amount"))})
_rule("rule_required_fields", lambda: {
    "missing_order_id": rules.missing_field(F.col("doc"), "order_id"),
    "missing_currency": rules.missing_field(F.col("doc"), "currency")})
_rule("rule_schema", lambda: {"broken": rules.wrong_type(F.col("doc"))})
_rule("rule_numeric", lambda: {"broken": rules.not_numeric(F.col("doc"), "amount")})
_rule("rule_tax_consistency", lambda: {"broken": rules.tax_mismatch(F.col("amount"), F.col("tax_amount"), 0.08)})
_rule("rule_currency", lambda: {"broken": rules.outside(F.col("currency"), rules.CURRENCIES)})
_rule("rule_payment_method", lambda: {"broken": rules.outside(F.col("payment_method"), rules.PAYMENT_METHODS)})
_rule("rule_country", lambda: {"broken": rules.outside(F.col("country"), rules.COUNTRIES)})
_rule("rule_time", lambda: {"broken": rules.bad_time(F.col("event_ts"), F.col("ingest_ts"))})


@query
def valid_invalid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = rules.split_valid(checkout_events(spark, sf_dir))
    return good.select("event_id", F.lit("valid").alias("side")).unionByName(
        bad.select("event_id", F.lit("invalid").alias("side")))


@query
def anomaly_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir).select("event_id", "bad")


@query
def expect_amount_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = checkout_events(spark, sf_dir)
    return validation.check(df, [validation.expect_between(df, "amount", low=0, strict_low=True)])


@query
def expect_tax_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = checkout_events(spark, sf_dir)
    return validation.check(df, [validation.expect_not_null(df, "tax_amount", 0.90)])


@query
def rule_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checkout rules as expectations, from one pass."""
    checks = [validation.expect_rule(r) for r in rules.checkout_rules()]
    return validation.check(parsed(spark, sf_dir), checks).select(
        "expectation", "element_count", "unexpected_count", "success")


@query
def unexpected_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = json_text.unexpected_keys(F.col("doc"), rules.EVENT_FIELDS)
    return parsed(spark, sf_dir).select("event_id", extra.alias("extra")).where(F.size("extra") > 0).select(
        "event_id", F.array_join("extra", "|").alias("fields"))


@query
def schema_drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.schema_drift_summary(checkout_events(spark, sf_dir)).select(
        "field_name", "records", clock("first_seen", "first_seen"), clock("last_seen", "last_seen"))


@query
def malformed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).where(rules.malformed(F.col("doc"), F.col("value"))).select("event_id", "value")


@query
def record_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.record_failures(checkout_events(spark, sf_dir)).select(
        "event_id", F.array_join("failure_reasons", "|").alias("failure_reasons"))


# Breaker.

@query
def running_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker.running_error_rate(flagged(spark, sf_dir)).select("event_id", "total", "failed", "error_rate")


@query
def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed(spark, sf_dir).select("event_id", "total", "failed", "error_rate", "breaker_open", "route")


@query
def circuit_breaker_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_user = breaker.circuit_breaker(flagged(spark, sf_dir), key=["user_id"], min_records=5)
    return per_user.select("event_id", "user_id", "total", "failed", "error_rate", "route")


# Slices of a few hundred rows, so that these tables too are cut several times over.
FEW_ROWS = 300


def skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows at one time, and a third of the rows of one user."""
    third = F.col("event_id") % 3
    return flagged(spark, sf_dir).withColumns({
        "event_ts": F.when(third == 0, F.lit("2024-01-09 00:00:00").cast(T.TimestampNTZType())).otherwise(F.col("event_ts")),
        "user_id": F.when(third == 1, F.lit(7)).otherwise(F.col("user_id"))})


@query
def circuit_breaker_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = breaker.circuit_breaker(skewed(spark, sf_dir), rows_per_slice=FEW_ROWS)
    return cut.select("event_id", "total", "failed", "error_rate", "route")


@query
def circuit_breaker_hot_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = breaker.circuit_breaker(skewed(spark, sf_dir), key=["user_id"], min_records=5, rows_per_slice=FEW_ROWS)
    return cut.select("event_id", "user_id", "total", "failed", "error_rate", "route")


@query
def breaker_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breaker.state_after(flagged(spark, sf_dir))


@query
def rolling_null_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = metrics.rolling_null_ratio(checkout_events(spark, sf_dir), rules.null_tax(F.col("tax_amount")))
    return rolled.select(clock("window_start", "window_start"), "records", "flagged", "ratio")


# Reports and metrics.

@query
def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.dq_metrics(checkout_events(spark, sf_dir))


@query
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_report(validation.validation_report(checkout_events(spark, sf_dir), _newest_millis()))


@query
def validation_report_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = checkout_events(spark, sf_dir).withColumn("day", F.date_format("event_ts", "yyyy-MM-dd"))
    return _flat_report(validation.validation_report(days, _newest_millis(), by=["day"]), "day")


@query
def validation_report_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a selection that turns out to hold no rows: amounts beyond any in the table."""
    none = checkout_events(spark, sf_dir).where(F.col("amount") > 1_000_000_000)
    return _flat_report(validation.validation_report(none, _newest_millis()))


@query
def expectation_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite(spark, sf_dir, write_contract(spark, sf_dir))


@query
def expectation_suite_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite(spark, sf_dir, write_contract_damaged(spark, sf_dir))


def _suite(spark: SparkSession, sf_dir: str, contract: DataFrame) -> DataFrame:
    kept = contract.select(F.col("contract") == "PASS").scalar()
    # Types are looked at where the flag is, so the text is parsed once and not carried through the breaker.
    seen = parsed(spark, sf_dir).withColumns({
        "bad": json_text.flag_document(F.col("doc"), F.col("value")), "wrong": rules.wrong_type(F.col("doc"))}).drop("doc", "value")
    suite = validation.expectation_suite(breaker.circuit_breaker(seen), kept, wrong="wrong")
    listed = F.transform("expectations", lambda e: F.concat(e["expectation"], F.lit("="), e["status"]))
    return suite.select(
        "status", "total_assertions", "successful_assertions", "success_rate_percent",
        F.array_join("failures", "|").alias("failures"), "metrics.*", F.array_join(listed, "|").alias("expectations"))


@query
def null_tax_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.null_tax_ratio(checkout_events(spark, sf_dir))


def _intervals(spark: SparkSession, sf_dir: str, interval: str = "1 minute") -> DataFrame:
    return metrics.metrics_by_interval(routed(spark, sf_dir), interval)


@query
def metrics_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _intervals(spark, sf_dir).withColumn("interval_start", clock("interval_start", "interval_start"))


@query
def metrics_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.running_totals(_intervals(spark, sf_dir)).withColumn(
        "interval_start", clock("interval_start", "interval_start"))


@query
def latency_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = metrics.rolling_latency(checkout_events(spark, sf_dir))
    return rolled.withColumn("window_start", clock("window_start", "window_start"))


@query
def latency_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = metrics.latency_windows(metrics.latency_histogram(checkout_events(spark, sf_dir)))
    return rolled.withColumn("window_start", clock("window_start", "window_start"))


@query
def metrics_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest figures. All has arrived, the pipeline has taken the first two slices: its commit log gives commits and backlog."""
    events = checkout_events(spark, sf_dir)
    log = _run_pipeline(spark, sf_dir, parts=2).commits().read(spark)
    commits = log.agg(F.count(F.lit(1)).alias("n"))
    waiting = events.agg((F.count(F.lit(1)) - log.agg(F.sum("records_added")).scalar()).alias("n"))
    latest = metrics.rolling_latency(events).agg(F.max_by("avg_latency_ms", "window_start").alias("ms"))
    return metrics.current_metrics(
        _intervals(spark, sf_dir), commits.scalar(), waiting.scalar(), latest.scalar())


@query
def dlq_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    diverted = breaker.circuit_breaker(flagged(spark, sf_dir)).where("breaker_open")
    return rules.failures_by_reason(rules.record_failures(diverted))


@query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_summary(rules.record_failures(checkout_events(spark, sf_dir)))


@query
def series_last_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latest_series(_intervals(spark, sf_dir)).withColumn(
        "interval_start", clock("interval_start", "interval_start"))


@query
def metric_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metric_band(_intervals(spark, sf_dir, "1 hour")).select(
        clock("interval_start", "interval_start"), "error_rate", "breaker_open", "band")


# Reconciliation and commit log.

@query
def write_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, out = _written(spark, sf_dir)
    return ledger.write_contract(
        checkout_events(spark, sf_dir), writers.read_main(spark, root, out.schema),
        writers.read_dlq(spark, root, out.schema))


@query
def write_contract_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over tables from which rows were lost, in which rows stand twice, and to which strange ones were added."""
    root, out = _written(spark, sf_dir)
    number = F.col("event_id")

    def damaged(table: DataFrame) -> DataFrame:
        left = table.where(number % 101 != 0)
        strange = table.where(number % 107 == 0).withColumn("event_id", number + 1_000_000_000)
        return left.unionByName(left.where(number % 103 == 0)).unionByName(strange)

    return ledger.write_contract(
        checkout_events(spark, sf_dir), damaged(writers.read_main(spark, root, out.schema)),
        damaged(writers.read_dlq(spark, root, out.schema)))


@query
def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything was read, the last slice is not committed yet."""
    root = fresh_path(spark, "committed")
    done = routed(spark, sf_dir).where(slice_of() < 2).select("event_id", "route")
    writers.write_routed(done, root)
    return ledger.backlog(checkout_events(spark, sf_dir), writers.read_routed(spark, root, done.schema))


@query
def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "commits")
    events = checkout_events(spark, sf_dir).select(
        "event_id", "event_ts", F.col("ingest_ts").alias("committed_at"), F.lit(writers.MAIN_TABLE).alias("route"))
    for batch_id in range(3):
        writers.write_routed(events.where(slice_of() == batch_id), root, batch_id)
    return ledger.snapshot_log(writers.read_routed(spark, root, events.schema)).withColumn(
        "committed_at", clock("committed_at", "committed_at"))


@query
def duplicate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.duplicate_keys(checkout_events(spark, sf_dir))


# Incidents.

def _incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.breaker_incidents(_changes(spark, routed(spark, sf_dir), "event_ts", "event_id"))


def _changes(spark: SparkSession, routed_rows: DataFrame, *columns: str) -> DataFrame:
    """The transitions, cut from what led to them: pairing them runs several small jobs."""
    fresh_path(spark, "changes")  # makes sure there is a checkpoint folder
    return breaker.transitions(routed_rows, min_records=MINIMUM_RECORDS if "user_id" not in columns else 5).select(
        *columns, "opened").checkpoint()


def _shown(frame: DataFrame) -> DataFrame:
    for name in ("opened_at", "resolved_at"):
        if name in frame.columns:
            frame = frame.withColumn(name, clock(name, name))
    return frame


@query
def incidents_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_incidents(spark, sf_dir))


@query
def incidents_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(incidents.warning_incidents(_intervals(spark, sf_dir, "1 hour"), "1 hour"))


@query
def incidents_warning_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = incidents.warning_incidents(_intervals(spark, sf_dir, "10 seconds"), "10 seconds")
    return _shown(incidents.deduplicated(over.unionByName(over)))


@query
def incidents_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_user = breaker.circuit_breaker(flagged(spark, sf_dir), key=["user_id"], min_records=5)
    changes = _changes(spark, per_user, "user_id", "event_ts", "event_id")
    return _shown(incidents.deduplicated(incidents.breaker_incidents(changes, key=["user_id"])))


@query
def incidents_broker_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["timestamp", "partition", "offset"]
    messages = flagged(spark, sf_dir).withColumns({
        "timestamp": F.date_trunc("hour", "event_ts"), "partition": F.col("event_id") % 3,
        "offset": F.floor(F.col("event_id") / 3)})
    changes = _changes(spark, breaker.circuit_breaker(messages, order=order), *order)
    return _shown(incidents.deduplicated(incidents.breaker_incidents(changes, order)))


@query
def incidents_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _incidents(spark, sf_dir).drop("resolved_at").unionByName(
        incidents.warning_incidents(_intervals(spark, sf_dir, "1 hour"), "1 hour"))
    return _shown(incidents.latest(both))


@query
def incidents_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    still = incidents.active(_incidents(spark, sf_dir))
    return _shown(still.withColumn("active_count", still.agg(F.count(F.lit(1))).scalar()))


@query
def incidents_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every incident announced twice, kept once."""
    once = _incidents(spark, sf_dir)
    return _shown(incidents.deduplicated(once.unionByName(once)))


@query
def pipeline_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.pipeline_status(breaker.state_after(flagged(spark, sf_dir)))


# Streams: the table arrives in three slices, the job is started anew for each and continues where it stopped.

def _arrive(spark: SparkSession, sf_dir: str, root: str, part: int) -> None:
    events = checkout_events(spark, sf_dir).where(slice_of() == part)
    events.select("event_id", F.col("event_ts").cast("timestamp"), "value").write.mode("append").parquet(
        f"{root}/inbox")


def _run_stream(spark: SparkSession, sf_dir: str, parts: int = 3, reports: progress.ProgressLog | None = None) -> str:
    root = fresh_path(spark, "stream")
    schema = spark.createDataFrame([], STAGED).schema
    for part in range(parts):
        _arrive(spark, sf_dir, root, part)
        events = readers.read_events(spark, "parquet", schema, path=f"{root}/inbox")
        started = job.start(events, root, f"{root}/checkpoint", available_now=True)
        started.awaitTermination()
        if reports:
            reports.wait_for(started)
    return root


def _stream_rows(spark: SparkSession, root: str) -> DataFrame:
    schema = spark.createDataFrame([], f"{STAGED}, bad boolean, total bigint, failed bigint, error_rate double, "
                                       "breaker_open boolean").schema
    return writers.read_routed(spark, root, schema)


@query
def stream_circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_rows(spark, _run_stream(spark, sf_dir)).select("event_id", "total", "failed", "error_rate", "route")


@query
def side_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream_rows(spark, _run_stream(spark, sf_dir))
    return rows.groupBy("batch_id", "route").agg(F.count(F.lit(1)).alias("records"))


@query
def stream_breaker_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job.read_state(spark, _run_stream(spark, sf_dir)).select("batch_id", "total", "failed")


@query
def stream_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch holds that has been reported as finished, going by the progress log."""
    log = fresh_path(spark, "progress")
    with progress.recorded(spark, log) as reports:
        root = _run_stream(spark, sf_dir, reports=reports)
    rows = _stream_rows(spark, root).groupBy("batch_id").agg(F.count(F.lit(1)).alias("records"))
    return progress.read_progress(spark, log).select("batch_id").join(rows, "batch_id", "left")


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the last start nothing is new; each event has been written once."""
    root = _run_stream(spark, sf_dir)
    events = readers.read_events(spark, "parquet", spark.createDataFrame([], STAGED).schema, path=f"{root}/inbox")
    job.start(events, root, f"{root}/checkpoint", available_now=True).awaitTermination()
    rows = _stream_rows(spark, root)
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("event_id").alias("events"),
        F.min("total").alias("first_total"), F.max("total").alias("last_total"))


# Messages through the whole pipeline: text in, routes, causes, counters, incidents and commits out.

MESSAGE = "event_id bigint, event_ts timestamp, ingest_ts timestamp, user_id bigint, value string"


def _run_pipeline(
    spark: SparkSession, sf_dir: str, parts: int = 3, reports: progress.ProgressLog | None = None, **settings,
) -> pipeline.Pipeline:
    """The table arrives in three slices, the pipeline is started anew for each of the first ``parts``."""
    root = fresh_path(spark, "pipeline")
    made = pipeline.Pipeline(root, **settings)
    for part in range(parts):
        events = checkout_events(spark, sf_dir).where(slice_of() == part)
        events.select("event_id", F.col("event_ts").cast("timestamp"), F.col("ingest_ts").cast("timestamp"),
                      F.col("user_id").cast("bigint"), "value").write.mode("append").parquet(f"{root}/inbox")
        messages = readers.read_events(spark, "parquet", T._parse_datatype_string(MESSAGE), path=f"{root}/inbox")
        started = pipeline.start_pipeline(messages, made, f"{root}/checkpoint", available_now=True)
        started.awaitTermination()
        if reports:
            reports.wait_for(started)
    return made


@query
def stream_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pipeline.read_records(spark, _run_pipeline(spark, sf_dir))
    return json_text.with_variant(rows).select(
        "batch_id", "event_id", "total", "failed", "route", F.array_join("failure_reasons", "|").alias("failure_reasons"),
        F.try_variant_get("doc", "$.error_rate", "double").alias("error_rate"))


@query
def stream_breaker_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pipeline.read_records(spark, _run_pipeline(spark, sf_dir, key_schema="user_id bigint", min_records=5))
    return rows.select("event_id", "user_id", "total", "failed", "error_rate", "route")


@query
def stream_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_run_pipeline(spark, sf_dir).incidents().read(spark))


@query
def stream_incidents_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_run_pipeline(spark, sf_dir, key_schema="user_id bigint", min_records=5).incidents().read(spark))


@query
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pipeline.read_intervals(spark, _run_pipeline(spark, sf_dir))
    return rows.drop("final").withColumn("interval_start", clock("interval_start", "interval_start"))


@query
def stream_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pipeline.read_commits(spark, _run_pipeline(spark, sf_dir))
    return rows.withColumn("committed_at", clock("committed_at", "committed_at"))


@query
def stream_metrics_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows, also the last ones, which are not final yet."""
    rows = pipeline.read_intervals(spark, _run_pipeline(spark, sf_dir))
    return rows.select(clock("interval_start", "window_start"), *metrics.COUNTERS, "final")


@query
def stream_metrics_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pipeline.read_windows(spark, _run_pipeline(spark, sf_dir))
    return rows.select(clock("window_start", "window_start"), *metrics.COUNTERS, "final")


@query
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histograms of three batches, merged."""
    rows = pipeline.read_latency(spark, _run_pipeline(spark, sf_dir))
    return rows.withColumn("window_start", clock("window_start", "window_start"))


@query
def stream_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the whole table each finished batch leaves to be taken: progress rows say which batches are done, commit rows what they hold."""
    log = fresh_path(spark, "progress")
    with progress.recorded(spark, log) as reports:
        made = _run_pipeline(spark, sf_dir, reports=reports)
    done = progress.read_progress(spark, log).select("batch_id", (F.col("checkpoint_duration_ms") >= 0).alias("timed"))
    events = checkout_events(spark, sf_dir).agg(F.count(F.lit(1))).scalar()
    commits = pipeline.read_commits(spark, made).withColumn("batch_id", F.substring_index("snapshot_id", "-", -1).cast("bigint"))
    return commits.join(done, "batch_id").select("batch_id", "records_added", (events - F.col("total_records")).alias("backlog"), "timed")
