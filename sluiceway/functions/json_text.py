"""Column builders over JSON text. Everything stays in built-in Variant expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.schema import DIVERTED_REASON, DIVERTED_STATUS

_BLANK = r"^[ \t\r\n]*$"
_ANNOTATIONS = ("anomaly_status", "anomaly_reason", "error_rate")


def decode_value(df: DataFrame, value: str = "value") -> DataFrame:
    """Message bytes to text, bytes that are not UTF-8 become the replacement character.

    The key and any headers are dropped, the position in the source is kept.
    """
    kept = [c for c in ("partition", "offset", "timestamp") if c in df.columns]
    return df.select(F.make_valid_utf8(F.col(value).cast("string")).alias("value"), *kept)


def is_valid_json(value: Column) -> Column:
    """True for any JSON value and for blank text, false for broken text and NULL."""
    return F.coalesce(F.try_parse_json(value).isNotNull() | value.rlike(_BLANK), F.lit(False))


def with_variant(df: DataFrame, value: str = "value", out: str = "doc") -> DataFrame:
    """Parse the text once; later columns read the parsed document."""
    return df.withColumn(out, F.try_parse_json(F.col(value)))


def field(doc: Column, name: str) -> Column:
    """Top-level field as Variant: NULL when absent, a Variant null when present and null."""
    return F.try_variant_get(doc, f"$['{name}']", "variant")


def is_null_field(doc: Column, name: str) -> Column:
    """Key present and JSON null (an absent key does not count)."""
    return F.coalesce(F.is_variant_null(field(doc, name)), F.lit(False))


def is_missing_field(doc: Column, name: str) -> Column:
    """Key absent or JSON null, looked at only where the text could be parsed."""
    probe = field(doc, name)
    return doc.isNotNull() & (probe.isNull() | F.is_variant_null(probe))


def flag_anomalies(df: DataFrame, value: str = "value", out: str = "bad", probe: str = "tax_amount") -> DataFrame:
    """Add the stream job's anomaly flag: the probed key is null, or the text is not JSON.

    NULL text (a tombstone message) is an anomaly, blank text is not.
    """
    flag = flag_document(F.col("__doc"), F.col(value), probe)
    return with_variant(df, value, "__doc").withColumn(out, flag).drop("__doc")


def flag_document(doc: Column, value: Column, probe: str = "tax_amount") -> Column:
    """The same flag from a document that has been parsed already."""
    broken = doc.isNull() & F.coalesce(~value.rlike(_BLANK), F.lit(True))
    return is_null_field(doc, probe) | broken


def as_object(doc: Column) -> Column:
    """Top-level keys of a JSON object as a map, NULL for every other document."""
    return doc.try_cast("map<string,variant>")


def unexpected_keys(doc: Column, known: Sequence[str]) -> Column:
    """Keys of the object outside the known list, empty when there are none."""
    extra = F.array_except(F.map_keys(as_object(doc)), F.array(*[F.lit(k) for k in known]))
    return F.coalesce(F.sort_array(extra), F.array().cast("array<string>"))


def present(*values: Column) -> Column:
    """Array of the values that are not null. Unlike a filter with a lambda this stays in generated code."""
    return F.array_except(F.array(*values), F.array(F.lit(None).cast("string")))


def annotate(value: Column, rate: Column, reason: Column | str = DIVERTED_REASON) -> Column:
    """Put the three diversion keys into a JSON object; any other text stays as it is.

    Existing keys of the same name are replaced. Keys come out sorted and numbers in Spark's notation,
    so compare annotated text by value.
    """
    return annotate_document(F.try_parse_json(value), value, rate, reason)


def annotate_document(doc: Column, value: Column, rate: Column, reason: Column | str = DIVERTED_REASON) -> Column:
    """The same from a document that has been parsed already; ``value`` is its text."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    kept = F.map_filter(as_object(doc), lambda k, _: ~k.isin(*_ANNOTATIONS))
    added = F.create_map(
        F.lit("anomaly_status"), F.lit(DIVERTED_STATUS).cast("variant"),
        F.lit("anomaly_reason"), reason.cast("variant"),
        F.lit("error_rate"), rate.cast("double").cast("variant"),
    )
    return F.coalesce(F.to_json(F.map_concat(kept, added)), value)


def to_json_text(record: Column) -> Column:
    """Struct to JSON text with nulls written out; a NULL record gives an empty object."""
    return F.coalesce(F.to_json(record, {"ignoreNullFields": "false"}), F.lit("{}"))


def parse_typed(
    df: DataFrame,
    fields: dict[str, str],
    defaults: dict[str, object] | None = None,
    value: str = "value",
    out: str = "record",
) -> DataFrame:
    """Bind the text to a struct, or NULL as soon as anything does not fit.

    ``fields`` maps JSON keys to Spark types. Broken text, a document that is not an object, a key outside
    ``fields`` or a value that cannot be converted all give NULL. ``defaults`` fills absent or null keys, as
    primitive members of a record class do.
    """
    defaults = defaults or {}
    doc, obj = F.col("__doc"), F.col("__obj")
    parts, bad = [], F.size(F.array_except(F.map_keys(obj), F.array(*[F.lit(k) for k in fields]))) > 0
    for name, kind in fields.items():
        raw = field(doc, name)
        typed = F.try_variant_get(doc, f"$['{name}']", kind)
        nested = F.coalesce(F.schema_of_variant(raw).rlike("^(OBJECT|ARRAY)"), F.lit(False))
        bad = bad | nested | (raw.isNotNull() & ~F.is_variant_null(raw) & typed.isNull())
        if name in defaults:
            typed = F.coalesce(typed, F.lit(defaults[name]).cast(kind))
        parts.append(typed.alias(name))
    record = F.when(obj.isNotNull() & ~bad, F.struct(*parts))
    return (
        with_variant(df, value, "__doc")
        .withColumn("__obj", as_object(doc))
        .withColumn(out, record)
        .drop("__doc", "__obj")
    )
