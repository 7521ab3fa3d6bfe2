"""Data-quality operators for event streams and tables, as plain Spark DataFrame code."""

from sluiceway.functions.json_text import annotate, decode_value, flag_anomalies, is_valid_json, parse_typed
from sluiceway.operators.breaker import breaker_state, circuit_breaker, running_error_rate, transitions
from sluiceway.operators.incidents import breaker_incidents, warning_incidents
from sluiceway.operators.ledger import backlog, duplicate_keys, snapshot_log, write_contract
from sluiceway.operators.metrics import metrics_by_interval, rolling_latency, rolling_null_ratio, running_totals
from sluiceway.operators.rules import Rule, checkout_rules, record_failures
from sluiceway.operators.running import running_sums
from sluiceway.operators.validation import (
    check, expect_between, expect_not_null, expect_rule, expectation_suite, validation_report,
)
from sluiceway.session import configure
from sluiceway.sources.readers import read_events
from sluiceway.sources.writers import read_dlq, read_main, write_routed
from sluiceway.streaming.job import start

__all__ = [
    "Rule", "annotate", "backlog", "breaker_incidents", "breaker_state", "check", "checkout_rules",
    "circuit_breaker", "configure", "decode_value", "duplicate_keys", "expect_between", "expect_not_null",
    "expect_rule", "expectation_suite", "flag_anomalies", "is_valid_json", "metrics_by_interval", "parse_typed",
    "read_dlq", "read_events", "read_main", "record_failures", "rolling_latency", "rolling_null_ratio",
    "running_error_rate", "running_sums", "running_totals", "snapshot_log", "start", "transitions",
    "validation_report", "warning_incidents", "write_contract", "write_routed",
]
