"""Data-quality rules: a rule is a named column that is true where a record breaks it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.json_text import as_object, field, is_missing_field, present, unexpected_keys, with_variant
from sluiceway.functions.scalars import expected_tax
from sluiceway.schema import COUNTRIES, CURRENCIES, EVENT_FIELDS, PAYMENT_METHODS


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a bad record; ``mostly`` is the share of records that has to be fine."""

    name: str
    broken: Column
    severity: str = "CRITICAL"
    mostly: float = 1.0


# Rules over typed columns.

def null_tax(tax: Column) -> Column:
    """No tax amount, whether the key was null or absent."""
    return tax.isNull()


def negative_amount(amount: Column) -> Column:
    """Below zero; zero itself is fine here."""
    return F.coalesce(amount < 0, F.lit(False))


def is_valid(amount: Column, tax: Column) -> Column:
    return ~null_tax(tax) & ~negative_amount(amount)


def outside(x: Column, allowed: Sequence[str]) -> Column:
    """A value that is present but not in the allowed set."""
    return F.coalesce(~x.isin(*allowed), F.lit(False))


def tax_mismatch(amount: Column, tax: Column, rate: float, tolerance: float = 0.01) -> Column:
    """Tax that differs from what the amount calls for by more than the tolerance."""
    limit = F.lit(str(tolerance)).cast("decimal(18,4)")
    return F.coalesce(F.abs(tax - expected_tax(amount, rate)) > limit, F.lit(False))


def bad_time(event_ts: Column, ingest_ts: Column) -> Column:
    """No event time, or ingested before it happened."""
    return event_ts.isNull() | F.coalesce(ingest_ts < event_ts, F.lit(False))


# Rules over the parsed document. Text that is not JSON is left to the malformed rule.

def missing_field(doc: Column, name: str) -> Column:
    return F.coalesce(is_missing_field(doc, name), F.lit(False))


def not_numeric(doc: Column, name: str) -> Column:
    """Key present and not null, but its value does not read as an amount."""
    raw = field(doc, name)
    typed = F.try_variant_get(doc, f"$['{name}']", "decimal(18,2)")
    return F.coalesce(raw.isNotNull() & ~F.is_variant_null(raw) & typed.isNull(), F.lit(False))


def wrong_type(doc: Column) -> Column:
    """A known field of another JSON type: text fields hold text, amounts hold numbers; null is allowed."""
    out = F.lit(False)
    for name in EVENT_FIELDS:
        kind = F.schema_of_variant(field(doc, name))
        if name in ("amount", "tax_amount"):
            fits = kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT", "VOID")
        else:
            fits = kind.isin("STRING", "VOID")
        out = out | F.coalesce(~fits, F.lit(False))
    return out


def has_unexpected(doc: Column, known: Sequence[str] = EVENT_FIELDS) -> Column:
    extra = F.array_except(F.map_keys(as_object(doc)), F.array(*[F.lit(k) for k in known]))
    return F.coalesce(F.size(extra) > 0, F.lit(False))


def malformed(doc: Column, value: Column) -> Column:
    return doc.isNull() & F.coalesce(~value.rlike(r"^[ \t\r\n]*$"), F.lit(True))


def checkout_rules(
    rate: float = 0.08, value: str = "value", doc: str = "doc", order_id: str = "order_id",
) -> list[Rule]:
    """The rules for checkout events, over typed columns plus the parsed document in ``doc``."""
    c = F.col
    return [
        Rule("malformed_json", malformed(c(doc), c(value))),
        Rule("missing_order_id", missing_field(c(doc), "order_id")),
        Rule("missing_currency", missing_field(c(doc), "currency")),
        Rule("invalid_amount", not_numeric(c(doc), "amount")),
        Rule("schema_mismatch", wrong_type(c(doc))),
        Rule("unexpected_field", has_unexpected(c(doc)), "WARNING"),
        Rule("null_tax", null_tax(c("tax_amount")), "WARNING", 0.90),
        Rule("negative_amount", negative_amount(c("amount"))),
        Rule("tax_mismatch", tax_mismatch(c("amount"), c("tax_amount"), rate), "WARNING"),
        Rule("invalid_currency", outside(c("currency"), CURRENCIES)),
        Rule("invalid_country", outside(c("country"), COUNTRIES)),
        Rule("invalid_payment_method", outside(c("payment_method"), PAYMENT_METHODS)),
        Rule("invalid_time", bad_time(c("event_ts"), c("ingest_ts"))),
    ]


def record_failures(df: DataFrame, rules: Sequence[Rule] | None = None, value: str = "value") -> DataFrame:
    """Add ``failure_reasons``: the names of all rules a record breaks, in rule order, found in one pass."""
    rules = checkout_rules(value=value) if rules is None else rules
    return judge(with_variant(df, value, "doc"), rules).drop("doc")


def judge(parsed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same over rows whose text has been parsed already, into the column that the rules look at."""
    return parsed.withColumn("failure_reasons", present(*[F.when(r.broken, F.lit(r.name)) for r in rules]))


def split_valid(df: DataFrame, amount: str = "amount", tax: str = "tax_amount") -> tuple[DataFrame, DataFrame]:
    """Good records and bad records, decided record by record."""
    good = is_valid(F.col(amount), F.col(tax))
    return df.where(good), df.where(~good)


def schema_drift_summary(
    df: DataFrame, known: Sequence[str] = EVENT_FIELDS, value: str = "value", ts: str = "event_ts",
) -> DataFrame:
    """Unexpected field names with the number of records and when they were first and last seen."""
    extra = with_variant(df.select(value, ts), value, "doc").select(
        F.explode(unexpected_keys(F.col("doc"), known)).alias("field_name"), ts)
    return extra.groupBy("field_name").agg(
        F.count(F.lit(1)).alias("records"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def failures_by_reason(df: DataFrame, reasons: str = "failure_reasons") -> DataFrame:
    return (
        df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    )


def quality_summary(df: DataFrame, reasons: str = "failure_reasons") -> DataFrame:
    """One row: records in all, valid, invalid, with schema issues, with failed validations."""
    schema = F.arrays_overlap(F.col(reasons), F.array(
        *[F.lit(n) for n in ("malformed_json", "schema_mismatch", "unexpected_field")]))
    checks = F.size(F.array_except(F.col(reasons), F.array(
        *[F.lit(n) for n in ("malformed_json", "schema_mismatch", "unexpected_field")]))) > 0
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.size(reasons) == 0).alias("valid_records"),
        F.count_if(F.size(reasons) > 0).alias("invalid_records"),
        F.count_if(schema).alias("schema_issues"),
        F.count_if(checks).alias("validation_failures"),
    )
