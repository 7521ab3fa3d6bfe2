"""Every registered query against its SQL in another engine."""

import os

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from sluiceway.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()

# Survey keys that have to exist as queries.
KEYS = """
stream_source_files decode_value read_json_batch read_csv_batch write_main write_dlq topic_payloads keyed_json
report_roundtrip report_with_fallback parse_typed to_json_text valid_json null_tax_flag annotate_dlq canonicalize
normalize_time expected_tax metric_defaults clamp_pct rule_null_tax rule_negative_amount valid_invalid_split
anomaly_flag expect_amount_positive expect_tax_not_null rule_required_fields rule_schema rule_numeric
unexpected_fields schema_drift_summary malformed_events rule_tax_consistency rule_currency rule_payment_method
rule_country rule_time record_failures running_error_rate circuit_breaker side_outputs circuit_breaker_by_user
breaker_state rolling_null_ratio dq_metrics validation_report validation_report_empty expectation_suite
null_tax_ratio metrics_by_interval metrics_running_totals latency_rolling metrics_current dlq_by_reason dq_summary
write_contract backlog snapshot_log duplicate_orders incidents incidents_warning incidents_latest incidents_active
incidents_dedup series_last_30 metric_band pipeline_status stream_breaker_state stream_checkpoint
stream_circuit_breaker stream_metrics_windowed stream_restart write_contract_damaged expectation_suite_damaged circuit_breaker_skewed circuit_breaker_hot_user
incidents_by_user incidents_broker_order incidents_warning_10s
""".split()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_all_keys_are_registered():
    assert set(KEYS) <= set(QUERIES)
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry_has_the_breaker_columns(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["event_id", "total", "failed", "error_rate", "breaker_open", "route"]
    assert frame.count() == 1000
