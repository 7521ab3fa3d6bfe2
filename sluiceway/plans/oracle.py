"""The same queries as standard SQL over the same tables, for comparison in another engine."""

from __future__ import annotations

from sluiceway.operators import incidents as i
from sluiceway.operators import validation as v
from sluiceway.plans.checkout import CHECKOUT_SQL

_MAIN, _DLQ = "'ecommerce_events'", "'ecommerce_events_dlq'"
_TEXT = "'%Y-%m-%d %H:%M:%S'"
_KNOWN = "['order_id','user_id','amount','tax_amount','currency','country','payment_method','timestamp']"

_FLAGGED = """, flagged AS (
  SELECT *, CASE WHEN json_valid(value) THEN coalesce(json_type(value, '$.tax_amount') = 'NULL', false)
                 ELSE true END AS bad FROM raw)"""


def _breaker(order: str = "ts, event_id", by: str = "", least: int = 50, source: str = "flagged") -> str:
    return f""", counted AS (
  SELECT *, count(*) OVER w AS total, CAST(sum(CAST(bad AS INT)) OVER w AS BIGINT) AS failed
  FROM {source} WINDOW w AS ({by} ORDER BY {order} ROWS UNBOUNDED PRECEDING)
), rated AS (
  SELECT *, CAST(failed AS DOUBLE) / total AS error_rate,
         total >= {least} AND CAST(failed AS DOUBLE) / total > 0.02 AS breaker_open FROM counted
), routed AS (SELECT *, CASE WHEN breaker_open THEN {_DLQ} ELSE {_MAIN} END AS route FROM rated)"""


_ROUTED = _FLAGGED + _breaker()
# A third of the rows at one time, and a third of the rows of one user.
_SKEWED = _FLAGGED + """, skewed AS (
  SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-09 00:00:00' ELSE ts END AS ts,
                    CASE WHEN event_id % 3 = 1 THEN 7 ELSE user_id END AS user_id) FROM flagged)"""
_JUDGED = f""", documents_seen AS (
  SELECT *, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value END AS j FROM {{source}}
), judged AS (
  SELECT *, list_filter([
    CASE WHEN NOT ok THEN 'malformed_json' END,
    CASE WHEN ok AND coalesce(json_type(j, '$.order_id'), 'NULL') = 'NULL' THEN 'missing_order_id' END,
    CASE WHEN ok AND coalesce(json_type(j, '$.currency'), 'NULL') = 'NULL' THEN 'missing_currency' END,
    CASE WHEN json_type(j, '$.amount') <> 'NULL'
          AND TRY_CAST(json_extract_string(j, '$.amount') AS DECIMAL(18,2)) IS NULL THEN 'invalid_amount' END,
    CASE WHEN json_type(j, '$.amount') = 'VARCHAR' THEN 'schema_mismatch' END,
    CASE WHEN len(list_filter(json_keys(j), lambda k: NOT list_contains({_KNOWN}, k))) > 0
         THEN 'unexpected_field' END,
    CASE WHEN tax_amount IS NULL THEN 'null_tax' END,
    CASE WHEN amount < 0 THEN 'negative_amount' END,
    CASE WHEN abs(tax_amount - CASE WHEN amount > 0 THEN CAST(amount * CAST(0.08 AS DECIMAL(6,4)) AS DECIMAL(18,2))
                                    ELSE 0 END) > 0.01 THEN 'tax_mismatch' END,
    CASE WHEN currency NOT IN ('USD', 'INR', 'EUR') THEN 'invalid_currency' END,
    CASE WHEN country NOT IN ('USA', 'IND', 'DEU', 'FRA', 'GBR', 'CAN') THEN 'invalid_country' END,
    CASE WHEN payment_method NOT IN ('CREDIT_CARD', 'UPI', 'PAYPAL', 'APPLE_PAY', 'STRIPE')
         THEN 'invalid_payment_method' END,
    CASE WHEN ts IS NULL OR ingest_ts < ts THEN 'invalid_time' END], lambda r: r IS NOT NULL) AS reasons
  FROM documents_seen)"""
_GOOD = "(tax_amount IS NOT NULL AND amount >= 0)"


# Delays in sliding windows, in buckets of their seven leading binary digits.
_LATENCY = f"""SELECT strftime(start, {_TEXT}) AS window_start, CAST(sum(n) AS BIGINT) AS records,
    CAST(sum(total) AS DOUBLE) / sum(n) AS avg_latency_ms, max(high) AS max_latency_ms,
    min(middle) FILTER (WHERE seen >= ceil(0.5 * every)) AS p50_latency_ms,
    min(middle) FILTER (WHERE seen >= ceil(0.95 * every)) AS p95_latency_ms,
    min(middle) FILTER (WHERE seen >= ceil(0.99 * every)) AS p99_latency_ms
  FROM (SELECT *, (low + high) / 2.0::DOUBLE AS middle, sum(n) OVER (PARTITION BY start) AS every,
               sum(n) OVER (PARTITION BY start ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS seen
        FROM (SELECT start, sign(ms) * ((abs(ms) >> cut) << cut) AS bucket, count(*) AS n, sum(ms) AS total, min(ms) AS low, max(ms) AS high
              FROM (SELECT *, greatest(length(bin(abs(ms))) - 7, 0) AS cut
                    FROM (SELECT (epoch_us(ingest_ts) // 1000) - (epoch_us(ts) // 1000) AS ms,
                                 date_trunc('minute', ts) - INTERVAL 1 MINUTE * CAST(unnest(range(5)) AS INT) AS start FROM raw))
              GROUP BY 1, 2)) GROUP BY start"""


def _intervals(name: str, unit: str, seconds: int) -> str:
    return f""", {name} AS (
  SELECT date_trunc('{unit}', ts) AS start, count(*) AS incoming,
         count(*) FILTER (WHERE {_GOOD}) AS valid_events, count(*) FILTER (WHERE NOT {_GOOD}) AS invalid_events,
         count(*) FILTER (WHERE tax_amount IS NULL) AS null_tax_count,
         count(*) FILTER (WHERE amount <= 0) AS negative_amount_count,
         count(*) FILTER (WHERE breaker_open) AS dlq_count,
         CAST(count(*) AS DOUBLE) / {seconds} AS throughput,
         count(*) FILTER (WHERE NOT {_GOOD}) * 100.0::DOUBLE / count(*) AS error_rate,
         arg_max(breaker_open, total) AS breaker_open
  FROM routed GROUP BY 1)"""


_MINUTES = _ROUTED + _intervals("minutes", "minute", 60)
_HOURS = _ROUTED + _intervals("hours", "hour", 3600)


def _changes(order: str = "ts, event_id", by: str = "") -> str:
    return f""", changes AS (
  SELECT * FROM (SELECT *, lag(breaker_open, 1, false) OVER ({by} ORDER BY {order}) AS was_open FROM routed)
  WHERE breaker_open <> was_open
), paired AS (
  SELECT *, lead(ts) OVER ({by} ORDER BY {order}) AS closed_at FROM changes)"""


def _breaker_incidents(ident: str = "epoch_us(ts), '-', event_id", key: str = "") -> str:
    return f"""
  SELECT {key} concat('INC-', {ident}) AS incident_id, strftime(ts, {_TEXT}) AS opened_at,
         'CRITICAL' AS severity, '{i.breaker_rule()}' AS rule_violated, 'circuit breaker' AS affected_node,
         '{i.BREAKER_MESSAGE}' AS message, closed_at IS NOT NULL AS resolved,
         strftime(closed_at, {_TEXT}) AS resolved_at
  FROM paired WHERE breaker_open"""


_CHANGES = _ROUTED + _changes()
_BREAKER_INCIDENTS = _breaker_incidents()
# Messages in the order of a broker: the time of many is the same, offsets repeat between partitions.
_BROKER = _FLAGGED + """, broker AS (
  SELECT * REPLACE (date_trunc('hour', ts) AS ts), event_id % 3 AS part, event_id // 3 AS off FROM flagged)"""


def _warnings(source: str = "hours", seconds: int = 3600) -> str:
    return f"""
  SELECT concat('INC-W', strftime(start, '%Y%m%d%H%M%S'), '-{seconds}') AS incident_id, strftime(start, {_TEXT}) AS opened_at,
         'WARNING' AS severity, '{i.warning_rule()}' AS rule_violated, 'validator' AS affected_node,
         concat('Data validation warning: Null tax_amount rate touched ',
                CAST(round(null_tax_count * 100.0::DOUBLE / incoming, 2) AS VARCHAR), '%.') AS message,
         true AS resolved
  FROM {source} WHERE null_tax_count * 100.0::DOUBLE > 10.0 * incoming"""


_WARNING_INCIDENTS = _warnings()
_TENS = _ROUTED + _intervals("tens", "minute", 10).replace("date_trunc('minute', ts)", "time_bucket(INTERVAL '10 seconds', ts)")
# Events of which only the text is known.
_FROM_TEXT = ", ".join(f"TRY_CAST(json_extract_string(CASE WHEN json_valid(value) THEN value END, '$.{name}') AS {kind}) AS {name}" for name, kind in (
    ("amount", "DECIMAL(18,2)"), ("tax_amount", "DECIMAL(18,2)"), ("currency", "VARCHAR"), ("country", "VARCHAR"), ("payment_method", "VARCHAR")))
_MESSAGES = _FLAGGED + f", messages AS (SELECT * REPLACE ({_FROM_TEXT}) FROM flagged)" + _breaker(source="messages")
_MESSAGE_MINUTES = _MESSAGES + _intervals("minutes", "minute", 60).replace(_GOOD, "(tax_amount IS NOT NULL AND coalesce(amount >= 0, true))")
_PASSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM raw)"
_SLICE = "CASE WHEN extract(day FROM ts) <= 10 THEN 0 WHEN extract(day FROM ts) <= 20 THEN 1 ELSE 2 END"


def _report(source: str = "raw", by: str = "") -> str:
    """The two-rule report from counts, flattened."""
    group, lead = (f"GROUP BY {by}", f"{by}, ") if by else ("", "")
    return f""", counts AS (
  SELECT {lead}count(*) AS n, count(*) FILTER (WHERE tax_amount IS NULL) AS nulls,
         count(*) FILTER (WHERE amount <= 0) AS low, epoch_us(max(ts)) // 1000 AS stamp FROM {source} {group}
), verdicts AS (
  SELECT *, low = 0 AS ok1, n = 0 OR CAST(n - nulls AS DOUBLE) / n >= 0.90 AS ok2 FROM counts
), report AS (
  SELECT {lead}stamp AS timestamp,
    CASE WHEN n = 0 THEN 'WARNING' WHEN NOT ok1 THEN 'ERROR' WHEN NOT ok2 THEN 'WARNING' ELSE 'OK' END AS status,
    CASE WHEN n = 0 THEN '{v.EMPTY_BATCH}' END AS message,
    CASE WHEN n = 0 THEN 0 ELSE 2 END AS total_assertions,
    CASE WHEN n = 0 THEN 0 ELSE CAST(ok1 AS INT) + CAST(ok2 AS INT) END AS successful_assertions,
    CASE WHEN n = 0 THEN 100.0::DOUBLE ELSE (CAST(ok1 AS INT) + CAST(ok2 AS INT)) * 50.0::DOUBLE END
      AS success_rate_percent,
    CASE WHEN ok1 AND ok2 THEN '' WHEN ok2 THEN '{v.AMOUNT_FAILED}' WHEN ok1 THEN '{v.TAX_FAILED}'
         ELSE '{v.AMOUNT_FAILED}|{v.TAX_FAILED}' END AS failures,
    n AS total_rows_evaluated, nulls AS null_tax_count, low AS negative_amount_count
  FROM verdicts)"""


def _sql(select: str, ctes: str = "") -> str:
    return f"WITH {CHECKOUT_SQL}{ctes}\n{select}"


def _judged(source: str = "raw") -> str:
    return _JUDGED.format(source=source)


def _suite(kept: bool) -> str:
    """The four-expectation report; ``kept`` is what the write contract says."""
    nulls = "count(*) FILTER (WHERE tax_amount IS NULL)"
    return f"""SELECT CASE WHEN passed = 4 THEN 'OK' ELSE 'ERROR' END AS status,
              4 AS total_assertions, passed AS successful_assertions, round(passed / 4.0::DOUBLE * 100, 1) AS success_rate_percent,
              CASE WHEN ok1 AND ok2 THEN '' WHEN ok1 THEN '{v.SUITE_TAX_FAILED}' WHEN ok2 THEN '{v.SUITE_AMOUNT_FAILED}'
                   ELSE '{v.SUITE_TAX_FAILED}|{v.SUITE_AMOUNT_FAILED}' END AS failures,
              n AS total_rows_evaluated, nulls AS null_tax_count, round(nulls * 100.0::DOUBLE / n, 2) AS null_tax_ratio_percent,
              low AS negative_amount_count, good AS valid_events, n - good AS invalid_events, dlq AS dlq_count,
              concat('amount > 0=', CASE WHEN ok1 THEN 'PASS' ELSE 'FAIL' END,
                     '|tax_amount not null > 90%=', CASE WHEN ok2 THEN 'PASS' ELSE 'FAIL' END,
                     '|schema validation=', CASE WHEN ok3 THEN 'PASS' ELSE 'FAIL' END,
                     '|Iceberg write contract={'PASS' if kept else 'FAIL'}') AS expectations
            FROM (SELECT *, CAST(ok1 AS INT) + CAST(ok2 AS INT) + CAST(ok3 AS INT) + {int(kept)} AS passed
                  FROM (SELECT *, low = 0 AS ok1, CAST(n - nulls AS DOUBLE) / n >= 0.90 AS ok2, wrong = 0 AS ok3
                        FROM (SELECT count(*) AS n, {nulls} AS nulls, count(*) FILTER (WHERE amount <= 0) AS low,
                                count(*) FILTER (WHERE {_GOOD}) AS good, count(*) FILTER (WHERE breaker_open) AS dlq,
                                count(*) FILTER (WHERE list_contains(reasons, 'schema_mismatch')) AS wrong FROM judged)))"""


def oracle_queries() -> dict[str, str]:
    routed_rows = "SELECT event_id, total, failed, error_rate, route FROM routed"
    broken = _judged()

    def rule(name: str) -> str:
        return _sql(f"SELECT event_id, list_contains(reasons, '{name}') AS broken FROM judged", broken)

    field = "CASE WHEN json_valid(value) THEN json_extract_string(value, '$.{0}') END"
    expectation = "SELECT '{0}' AS expectation, count(*) AS element_count, {1} AS missing_count, {2} AS unexpected_count, {3} AS success FROM raw"
    nulls = "count(*) FILTER (WHERE tax_amount IS NULL)"
    out = {
        "stream_source_files": _sql("SELECT event_id, value FROM raw"),
        "decode_value": _sql("SELECT 0 AS partition, event_id, value FROM raw"),
        "read_json_batch": _sql("""SELECT concat('ORD-', CAST(order_no AS VARCHAR)) AS order_id,
            concat('USR-', CAST(user_id AS VARCHAR)) AS user_id, CAST(amount AS DOUBLE) AS amount,
            CAST(tax_amount AS DOUBLE) AS tax_amount, 'COMPLETED' AS status, (epoch_us(ts) // 1000) AS timestamp FROM raw"""),
        "read_csv_batch": _sql("""SELECT order_no AS transaction_id, concat('U', CAST(user_id AS VARCHAR)) AS user_id,
            CAST(amount AS DOUBLE) AS amount, CAST(tax_amount AS DOUBLE) AS tax_amount,
            strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp FROM raw"""),
        "write_main": _sql(f"SELECT event_id, total, failed, value FROM routed WHERE route = {_MAIN}", _ROUTED),
        "write_dlq": _sql(f"""SELECT event_id, total, failed,
            CASE WHEN json_valid(value) THEN 'DIVERTED' END AS anomaly_status,
            CASE WHEN json_valid(value) THEN error_rate END AS error_rate FROM routed WHERE route = {_DLQ}""", _ROUTED),
        "topic_payloads": _sql(f"""SELECT CASE WHEN {_GOOD} THEN 'lake-events' ELSE 'lake-events-dlq' END AS topic,
            concat('ORD-', CAST(order_no AS VARCHAR)) AS key, value FROM raw"""),
        "keyed_json": _sql("""SELECT concat('ORD-', CAST(order_no AS VARCHAR)) AS key,
            concat('{"order_id":"ORD-', CAST(order_no AS VARCHAR), '","user_id":"USR-', CAST(user_id AS VARCHAR),
              '","amount":', CAST(amount AS VARCHAR), ',"tax_amount":', coalesce(CAST(tax_amount AS VARCHAR), 'null'),
              ',"currency":"', currency, '","country":"', country, '","payment_method":"', payment_method, '"}')
              AS value FROM raw"""),
        "report_roundtrip": _sql("SELECT * FROM report", _report()),
        "report_with_fallback": _sql("""SELECT 'absent' AS "case", * FROM report
            UNION ALL SELECT 'broken', * FROM report
            UNION ALL SELECT 'saved', * REPLACE ('SAVED' AS status) FROM report""", _report()),
        "parse_typed": _sql("""SELECT event_id, ok AND NOT drift AND NOT text_amount AS parsed,
            CASE WHEN ok AND NOT drift AND NOT text_amount THEN json_extract_string(j, '$.order_id') END AS order_id,
            CASE WHEN ok AND NOT drift AND NOT text_amount
                 THEN CAST(TRY_CAST(json_extract_string(j, '$.amount') AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
            CASE WHEN ok AND NOT drift AND NOT text_amount
                 THEN CAST(TRY_CAST(json_extract_string(j, '$.tax_amount') AS DECIMAL(18,2)) AS DOUBLE) END AS tax_amount,
            CASE WHEN ok AND NOT drift AND NOT text_amount THEN json_extract_string(j, '$.currency') END AS currency
            FROM judged""", broken),
        "to_json_text": _sql("""SELECT event_id, concat('{"transactionId":"ORD-', CAST(order_no AS VARCHAR),
              '","userId":"USR-', CAST(user_id AS VARCHAR), '","productId":null,"quantity":1,"price":',
              CAST(amount AS VARCHAR), ',"taxAmount":', coalesce(CAST(tax_amount AS VARCHAR), 'null'),
              ',"paymentMethod":"', payment_method, '","eventTimestamp":"', strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '"}')
              AS json FROM raw"""),
        "valid_json": _sql("SELECT event_id, json_valid(value) AS valid FROM raw"),
        "null_tax_flag": _sql("""SELECT event_id, CASE WHEN json_valid(value)
            THEN coalesce(json_type(value, '$.tax_amount') = 'NULL', false) ELSE false END AS null_tax FROM raw"""),
        "annotate_dlq": _sql("""SELECT event_id, json_extract_string(j, '$.order_id') AS order_id,
            CASE WHEN ok THEN 'DIVERTED' END AS anomaly_status, CASE WHEN ok THEN 'NULL_TAX_AMOUNT' END AS anomaly_reason,
            CASE WHEN ok THEN error_rate END AS error_rate, CAST(len(json_keys(j)) + 3 AS BIGINT) AS key_count,
            array_to_string(reasons, '|') AS failure_reasons FROM judged WHERE breaker_open""",
            _ROUTED + _judged("routed")),
        "canonicalize": _sql("""SELECT 'generator' AS shape, json_extract_string(j, '$.order_id') AS order_id,
              json_extract_string(j, '$.user_id') AS user_id,
              CAST(TRY_CAST(json_extract_string(j, '$.amount') AS DECIMAL(18,2)) AS DOUBLE) AS amount,
              CAST(TRY_CAST(json_extract_string(j, '$.tax_amount') AS DECIMAL(18,2)) AS DOUBLE) AS tax_amount,
              json_extract_string(j, '$.currency') AS currency, json_extract_string(j, '$.country') AS country,
              json_extract_string(j, '$.payment_method') AS payment_method, CAST(NULL AS VARCHAR) AS status,
              CAST(NULL AS BIGINT) AS quantity, CAST(NULL AS BIGINT) AS event_micros FROM judged
            UNION ALL SELECT 'transaction', concat('ORD-', CAST(order_no AS VARCHAR)),
              concat('USR-', CAST(user_id AS VARCHAR)), CAST(amount AS DOUBLE), CAST(tax_amount AS DOUBLE), NULL, NULL,
              payment_method, NULL, 1, epoch_us(ts) FROM raw
            UNION ALL SELECT 'validator', concat('ORD-', CAST(order_no AS VARCHAR)),
              concat('USR-', CAST(user_id AS VARCHAR)), CAST(amount AS DOUBLE), CAST(tax_amount AS DOUBLE), NULL, NULL,
              NULL, 'COMPLETED', NULL, (epoch_us(ts) // 1000) * 1000 FROM raw
            UNION ALL SELECT 'csv', CAST(order_no AS VARCHAR), concat('U', CAST(user_id AS VARCHAR)),
              CAST(amount AS DOUBLE), CAST(tax_amount AS DOUBLE), NULL, NULL, NULL, NULL, NULL, epoch_us(ts) FROM raw""",
            broken),
        "normalize_time": _sql("""SELECT event_id, epoch_us(ts) AS iso_micros, (epoch_us(ts) // 1000) * 1000 AS millis_micros,
            epoch_us(ts) AS plain_micros FROM raw"""),
        "expected_tax": _sql("""SELECT event_id,
            CASE WHEN amount > 0 THEN CAST(CAST(amount * CAST(0.08 AS DECIMAL(6,4)) AS DECIMAL(18,2)) AS DOUBLE)
                 ELSE 0.0::DOUBLE END AS tax_8,
            CASE WHEN amount > 0 THEN CAST(CAST(amount * CAST(0.18 AS DECIMAL(6,4)) AS DECIMAL(18,2)) AS DOUBLE)
                 ELSE 0.0::DOUBLE END AS tax_18 FROM raw"""),
        "metric_defaults": _sql(f"""SELECT event_id, coalesce(TRY_CAST({field.format('amount')} AS DOUBLE), 0) AS amount,
            coalesce(TRY_CAST({field.format('tax_amount')} AS DOUBLE), 0) AS tax_amount FROM raw"""),
        "clamp_pct": _sql("""SELECT event_id, greatest(0.0::DOUBLE, least(100.0::DOUBLE, CAST(amount AS DOUBLE)))
            AS percent FROM raw"""),
        "rule_null_tax": _sql("SELECT event_id, tax_amount IS NULL AS broken FROM raw"),
        "rule_negative_amount": _sql("SELECT event_id, amount < 0 AS broken FROM raw"),
        "rule_required_fields": _sql("""SELECT event_id, list_contains(reasons, 'missing_order_id') AS missing_order_id,
            list_contains(reasons, 'missing_currency') AS missing_currency FROM judged""", broken),
        "rule_schema": rule("schema_mismatch"),
        "rule_numeric": rule("invalid_amount"),
        "rule_tax_consistency": rule("tax_mismatch"),
        "rule_currency": rule("invalid_currency"),
        "rule_payment_method": rule("invalid_payment_method"),
        "rule_country": rule("invalid_country"),
        "rule_time": rule("invalid_time"),
        "valid_invalid_split": _sql(f"SELECT event_id, CASE WHEN {_GOOD} THEN 'valid' ELSE 'invalid' END AS side FROM raw"),
        "anomaly_flag": _sql("SELECT event_id, bad FROM flagged", _FLAGGED),
        "expect_amount_positive": _sql(expectation.format(
            "amount between", "count(*) FILTER (WHERE amount IS NULL)", "count(*) FILTER (WHERE amount <= 0)",
            "count(*) FILTER (WHERE amount <= 0) = 0")),
        "expect_tax_not_null": _sql(expectation.format(
            "tax_amount not null", nulls, nulls, f"CAST(count(*) - {nulls} AS DOUBLE) / count(*) >= 0.90")),
        "rule_expectations": _sql("""SELECT r.name AS expectation, r.n AS element_count, r.hit AS unexpected_count,
              CAST(r.n - r.hit AS DOUBLE) / r.n >= CASE WHEN r.name = 'null_tax' THEN 0.90 ELSE 1.0 END AS success
            FROM (SELECT names.name, count(*) AS n, count(*) FILTER (WHERE list_contains(reasons, names.name)) AS hit
                  FROM judged, (SELECT unnest(['malformed_json', 'missing_order_id', 'missing_currency',
                    'invalid_amount', 'schema_mismatch', 'unexpected_field', 'null_tax', 'negative_amount',
                    'tax_mismatch', 'invalid_currency', 'invalid_country', 'invalid_payment_method',
                    'invalid_time']) AS name) AS names GROUP BY 1) AS r""", broken),
        "unexpected_fields": _sql(f"""SELECT event_id, array_to_string(list_sort(list_filter(json_keys(j),
            lambda k: NOT list_contains({_KNOWN}, k))), '|') AS fields FROM judged
            WHERE list_contains(reasons, 'unexpected_field')""", broken),
        "schema_drift_summary": _sql(f"""SELECT field_name, count(*) AS records, strftime(min(ts), {_TEXT}) AS first_seen,
            strftime(max(ts), {_TEXT}) AS last_seen
            FROM (SELECT ts, unnest(json_keys(j)) AS field_name FROM judged)
            WHERE NOT list_contains({_KNOWN}, field_name) GROUP BY 1""", broken),
        "malformed_events": _sql("SELECT event_id, value FROM raw WHERE NOT json_valid(value)"),
        "record_failures": _sql("SELECT event_id, array_to_string(reasons, '|') AS failure_reasons FROM judged", broken),
        "running_error_rate": _sql("SELECT event_id, total, failed, error_rate FROM routed", _ROUTED),
        "circuit_breaker_skewed": _sql(
            "SELECT event_id, total, failed, error_rate, route FROM routed", _SKEWED + _breaker(source="skewed")),
        "circuit_breaker_hot_user": _sql(
            "SELECT event_id, user_id, total, failed, error_rate, route FROM routed",
            _SKEWED + _breaker(by="PARTITION BY user_id", least=5, source="skewed")),
        "incidents_by_user": _sql(
            _breaker_incidents("user_id, '-', epoch_us(ts), '-', event_id", "user_id,"),
            _FLAGGED + _breaker(by="PARTITION BY user_id", least=5) + _changes(by="PARTITION BY user_id")),
        "incidents_broker_order": _sql(
            _breaker_incidents("epoch_us(ts), '-', part, '-', off"),
            _BROKER + _breaker("ts, part, off", source="broker") + _changes("ts, part, off")),
        "incidents_warning_10s": _sql(_warnings("tens", 10), _TENS),
        "circuit_breaker": _sql("SELECT event_id, total, failed, error_rate, breaker_open, route FROM routed", _ROUTED),
        "circuit_breaker_by_user": _sql(f"""SELECT event_id, user_id, total, failed,
              CAST(failed AS DOUBLE) / total AS error_rate,
              CASE WHEN total >= 5 AND CAST(failed AS DOUBLE) / total > 0.02 THEN {_DLQ} ELSE {_MAIN} END AS route
            FROM (SELECT event_id, user_id, count(*) OVER w AS total, CAST(sum(CAST(bad AS INT)) OVER w AS BIGINT) AS failed
                  FROM flagged WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))""",
            _FLAGGED),
        "breaker_state": _sql("""SELECT total, failed, error_rate,
              CASE WHEN breaker_open THEN 'ENGAGED' ELSE 'CLOSED' END AS status, route,
              CASE WHEN breaker_open THEN concat('Null tax ratio exceeded 2% safety threshold. Current rate: ',
                CAST(round(error_rate * 100, 2) AS VARCHAR), '%') ELSE 'Data streams healthy' END AS reason
            FROM routed ORDER BY ts DESC, event_id DESC LIMIT 1""", _ROUTED),
        "rolling_null_ratio": _sql(f"""SELECT strftime(start, {_TEXT}) AS window_start, count(*) AS records,
              count(*) FILTER (WHERE tax_amount IS NULL) AS flagged,
              CAST(count(*) FILTER (WHERE tax_amount IS NULL) AS DOUBLE) / count(*) AS ratio
            FROM (SELECT tax_amount, date_trunc('minute', ts) - INTERVAL 1 MINUTE * CAST(unnest(range(5)) AS INT) AS start
                  FROM raw) GROUP BY start"""),
        "dq_metrics": _sql(f"""SELECT count(*) AS total_rows_evaluated, {nulls} AS null_tax_count,
            count(*) FILTER (WHERE amount <= 0) AS negative_amount_count FROM raw"""),
        "validation_report": _sql("SELECT * FROM report", _report()),
        "validation_report_by_day": _sql(
            "SELECT * FROM report", ", days AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM raw)"
            + _report("days", "day")),
        "validation_report_empty": _sql(
            "SELECT * FROM report", ", none AS (SELECT * FROM raw WHERE amount > 1000000000)" + _report("none")),
        "expectation_suite": _sql(_suite(True), _ROUTED + _judged("routed")),
        "expectation_suite_damaged": _sql(_suite(False), _ROUTED + _judged("routed")),
        "null_tax_ratio": _sql(f"""SELECT count(*) AS total_rows, {nulls} AS null_tax_count,
            round({nulls} * 100.0::DOUBLE / count(*), 2) AS null_tax_ratio_percent FROM raw"""),
        "metrics_by_interval": _sql(f"""SELECT strftime(start, {_TEXT}) AS interval_start, * EXCLUDE (start)
            FROM minutes""", _MINUTES),
        "metrics_running_totals": _sql(f"""SELECT strftime(start, {_TEXT}) AS interval_start,
              CAST(sum(incoming) OVER w AS BIGINT) AS processed_total, CAST(sum(valid_events) OVER w AS BIGINT) AS valid_total,
              CAST(sum(invalid_events) OVER w AS BIGINT) AS invalid_total, CAST(sum(dlq_count) OVER w AS BIGINT) AS dlq_total
            FROM minutes WINDOW w AS (ORDER BY start)""", _MINUTES),
        "latency_rolling": _sql(f"""SELECT strftime(start, {_TEXT}) AS window_start, count(*) AS records,
              CAST(sum(ms) AS DOUBLE) / count(*) AS avg_latency_ms, max(ms) AS max_latency_ms,
              quantile_cont(CAST(ms AS DOUBLE), 0.95) AS p95_latency_ms
            FROM (SELECT (epoch_us(ingest_ts) // 1000) - (epoch_us(ts) // 1000) AS ms,
                    date_trunc('minute', ts) - INTERVAL 1 MINUTE * CAST(unnest(range(5)) AS INT) AS start FROM raw)
            GROUP BY start"""),
        "latency_sketch": _sql(_LATENCY),
        "stream_latency": _sql(_LATENCY),
        "stream_backlog": _sql(f"""SELECT CAST(batch AS BIGINT) AS batch_id, n AS records_added,
              CAST((SELECT count(*) FROM raw) - sum(n) OVER (ORDER BY batch) AS BIGINT) AS backlog, true AS timed
            FROM (SELECT {_SLICE} AS batch, count(*) AS n FROM raw GROUP BY 1)"""),
        "metrics_current": _sql(f"""SELECT arg_max(throughput, start) AS throughput_events_per_sec,
              CAST(sum(incoming) AS BIGINT) AS processed_total, arg_max(error_rate, start) AS error_rate,
              CAST(sum(dlq_count) AS BIGINT) AS dlq_count, (SELECT count(DISTINCT {_SLICE}) FROM raw WHERE {_SLICE} < 2) AS checkpoint,
              (SELECT count(*) FROM raw WHERE {_SLICE} = 2) AS kafka_consumer_lag,
              (SELECT CAST(sum((epoch_us(ingest_ts) // 1000) - (epoch_us(ts) // 1000)) AS DOUBLE) / count(*) FROM raw
               WHERE date_trunc('minute', ts) = (SELECT max(date_trunc('minute', ts)) FROM raw)) AS latency_ms,
              CAST(sum(valid_events) AS BIGINT) AS valid_events, CAST(sum(invalid_events) AS BIGINT) AS invalid_events
            FROM minutes""", _MINUTES),
        "dlq_by_reason": _sql("""SELECT reason, count(*) AS records
            FROM (SELECT unnest(reasons) AS reason FROM judged WHERE breaker_open) GROUP BY 1""",
            _ROUTED + _judged("routed")),
        "dq_summary": _sql("""SELECT count(*) AS total_records, count(*) FILTER (WHERE len(reasons) = 0) AS valid_records,
              count(*) FILTER (WHERE len(reasons) > 0) AS invalid_records,
              count(*) FILTER (WHERE len(schema_ones) > 0) AS schema_issues,
              count(*) FILTER (WHERE len(reasons) > len(schema_ones)) AS validation_failures
            FROM (SELECT reasons, list_filter(reasons, lambda r: r IN ('malformed_json', 'schema_mismatch',
                    'unexpected_field')) AS schema_ones FROM judged)""", broken),
        "series_last_30": _sql(f"""SELECT strftime(start, {_TEXT}) AS interval_start, strftime(start, '%H:%M:%S') AS time_label,
            throughput, error_rate FROM minutes ORDER BY start DESC LIMIT 30""", _MINUTES),
        "metric_band": _sql(f"""SELECT strftime(start, {_TEXT}) AS interval_start, error_rate, breaker_open,
            CASE WHEN breaker_open THEN 'CRITICAL' WHEN error_rate >= 1.5 THEN 'WARNING' ELSE 'HEALTHY' END AS band
            FROM hours""", _HOURS),
        "write_contract": _sql("""SELECT count(*) AS input_records, count(*) FILTER (WHERE NOT breaker_open) AS main_records,
            count(*) FILTER (WHERE breaker_open) AS dlq_records, CAST(0 AS BIGINT) AS missing,
            CAST(0 AS BIGINT) AS duplicated, CAST(0 AS BIGINT) AS unexpected, 'PASS' AS contract FROM routed""", _ROUTED),
        "write_contract_damaged": _sql("""SELECT count(*) AS input_records,
            CAST(sum(times) FILTER (WHERE NOT breaker_open) AS BIGINT) AS main_records,
            CAST(sum(times) FILTER (WHERE breaker_open) AS BIGINT) AS dlq_records,
            count(*) FILTER (WHERE event_id % 101 = 0) AS missing,
            count(*) FILTER (WHERE event_id % 101 <> 0 AND event_id % 103 = 0) AS duplicated,
            count(*) FILTER (WHERE event_id % 107 = 0) AS unexpected, 'FAIL' AS contract
            FROM (SELECT *, CASE WHEN event_id % 101 = 0 THEN 0 WHEN event_id % 103 = 0 THEN 2 ELSE 1 END
                            + CASE WHEN event_id % 107 = 0 THEN 1 ELSE 0 END AS times FROM routed)""", _ROUTED),
        "backlog": _sql(f"SELECT count(*) AS backlog FROM raw WHERE {_SLICE} = 2"),
        "snapshot_log": _sql(f"""SELECT concat('snap-', CAST(batch AS VARCHAR)) AS snapshot_id,
              batch = max(batch) OVER () AS current, 'append' AS operation, n AS records_added,
              CAST(sum(n) OVER (ORDER BY batch) AS BIGINT) AS total_records, strftime(newest, {_TEXT}) AS committed_at,
              count(*) OVER () AS commit_count
            FROM (SELECT {_SLICE} AS batch, count(*) AS n, max(ingest_ts) AS newest FROM raw GROUP BY 1)"""),
        "duplicate_orders": _sql("""SELECT concat('ORD-', CAST(order_no AS VARCHAR)) AS order_id, count(*) AS records
            FROM raw GROUP BY 1 HAVING count(*) > 1"""),
        "incidents": _sql(_BREAKER_INCIDENTS, _CHANGES),
        "incidents_dedup": _sql(_BREAKER_INCIDENTS, _CHANGES),
        "incidents_active": _sql(f"""SELECT *, count(*) OVER () AS active_count FROM ({_BREAKER_INCIDENTS})
            WHERE NOT resolved""", _CHANGES),
        "incidents_warning": _sql(_WARNING_INCIDENTS, _HOURS),
        "incidents_latest": _sql(f"""SELECT * FROM (SELECT * EXCLUDE (resolved_at) FROM ({_BREAKER_INCIDENTS})
            UNION ALL {_WARNING_INCIDENTS}) ORDER BY opened_at DESC, incident_id DESC LIMIT 5""",
            _CHANGES + _intervals("hours", "hour", 3600)),
        "pipeline_status": _sql("""SELECT CASE WHEN breaker_open THEN 'DEGRADED' ELSE 'HEALTHY' END AS pipeline_health,
              CASE WHEN breaker_open THEN 'OPEN' ELSE 'CLOSED' END AS circuit_breaker,
              CASE WHEN breaker_open THEN 'PROTECTED' ELSE 'OPERATIONAL' END AS storage,
              CASE WHEN breaker_open THEN 'DEGRADED' ELSE 'OPERATIONAL' END AS quality, route,
              CASE WHEN breaker_open THEN concat('Null tax ratio exceeded 2% safety threshold. Current rate: ',
                CAST(round(error_rate * 100, 2) AS VARCHAR), '%') ELSE 'Data streams healthy' END AS reason
            FROM routed ORDER BY ts DESC, event_id DESC LIMIT 1""", _ROUTED),
        "stream_circuit_breaker": _sql(routed_rows, _ROUTED),
        "side_outputs": _sql(f"""SELECT CAST({_SLICE} AS BIGINT) AS batch_id, route, count(*) AS records FROM routed
            GROUP BY 1, 2""", _ROUTED),
        "stream_breaker_state": _sql(f"""SELECT CAST({_SLICE} AS BIGINT) AS batch_id, max(total) AS total,
            max(failed) AS failed FROM routed GROUP BY 1""", _ROUTED),
        "stream_checkpoint": _sql(f"SELECT CAST({_SLICE} AS BIGINT) AS batch_id, count(*) AS records FROM raw GROUP BY 1"),
        "stream_restart": _sql(f"""SELECT CAST({_SLICE} AS BIGINT) AS batch_id, count(*) AS records,
            count(DISTINCT event_id) AS events, min(total) AS first_total, max(total) AS last_total
            FROM routed GROUP BY 1""", _ROUTED),
        "stream_pipeline": _sql(f"""SELECT CAST({_SLICE} AS BIGINT) AS batch_id, event_id, total, failed, route,
            array_to_string(reasons, '|') AS failure_reasons, CASE WHEN ok AND breaker_open THEN error_rate END AS error_rate
            FROM judged""", _MESSAGES + _judged("routed")),
        "stream_incidents": _sql(_BREAKER_INCIDENTS, _CHANGES),
        "stream_metrics": _sql(f"""SELECT strftime(start, {_TEXT}) AS interval_start, * EXCLUDE (start)
            FROM minutes""", _MESSAGE_MINUTES),
        "stream_commits": _sql(f"""SELECT concat('snap-', CAST(batch AS VARCHAR)) AS snapshot_id, batch = max(batch) OVER () AS current,
              'append' AS operation, n AS records_added, CAST(sum(n) OVER (ORDER BY batch) AS BIGINT) AS total_records, main AS main_records,
              n - main AS dlq_records, CAST(0 AS BIGINT) AS late_records, strftime(newest, {_TEXT}) AS committed_at,
              row_number() OVER (ORDER BY batch) AS commit_count
            FROM (SELECT {_SLICE} AS batch, count(*) AS n, count(*) FILTER (WHERE NOT breaker_open) AS main, max(ingest_ts) AS newest
                  FROM routed GROUP BY 1)""", _ROUTED),
        "stream_metrics_windowed": _sql(f"""SELECT strftime(start, {_TEXT}) AS window_start, incoming, valid_events, invalid_events,
            null_tax_count, negative_amount_count, dlq_count, start + INTERVAL 1 MINUTE <= {_PASSED} AS final FROM minutes""", _MESSAGE_MINUTES),
        "stream_metrics_sliding": _sql(f"""SELECT strftime(began, {_TEXT}) AS window_start, CAST(sum(incoming) AS BIGINT) AS incoming,
              CAST(sum(valid_events) AS BIGINT) AS valid_events, CAST(sum(invalid_events) AS BIGINT) AS invalid_events,
              CAST(sum(null_tax_count) AS BIGINT) AS null_tax_count, CAST(sum(negative_amount_count) AS BIGINT) AS negative_amount_count,
              CAST(sum(dlq_count) AS BIGINT) AS dlq_count, began + INTERVAL 5 MINUTE <= {_PASSED} AS final
            FROM (SELECT *, start - INTERVAL 1 MINUTE * CAST(unnest(range(5)) AS INT) AS began FROM minutes) GROUP BY began""", _MESSAGE_MINUTES),
    }
    out["stream_breaker_by_user"] = out["circuit_breaker_by_user"]
    out["stream_incidents_by_user"] = out["incidents_by_user"]
    return out
