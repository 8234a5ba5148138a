"""Message decoding (UTF-8 -> JSON -> object) and envelope version handling.

Everything is a Column expression over the variant type, so decoding runs in
the JVM inside whole-stage codegen; no Python per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INVALID_JSON_PREFIX = "invalid JSON: "
NOT_OBJECT_REASON = "payload must be a JSON object"
UNSUPPORTED_VERSION_PREFIX = "unsupported schema_version: "


def message_text(value: Column) -> Column:
    return value.cast("string")


def parse_message(value: Column) -> Column:
    """Variant of the message bytes; SQL NULL when the bytes are not UTF-8 JSON."""
    text = message_text(value)
    return F.when(F.call_function("is_valid_utf8", text), F.try_parse_json(text))


def is_object(value: Column, parsed: Column) -> Column:
    """Whether well-formed JSON is an object, by its first character after
    white space: the type of a whole message as text costs more than parsing it."""
    return parsed.isNotNull() & message_text(value).rlike(r"^[ \t\r\n]*\{")


def base64_text(value: Column) -> Column:
    """Base64 without the MIME line breaks Spark inserts in long values."""
    return F.regexp_replace(F.base64(value), r"[\r\n]", "")


def decode_failure(value: Column, parsed: Column) -> Column:
    """Reason text of a message that is not a JSON object, else NULL."""
    utf8 = F.call_function("is_valid_utf8", message_text(value))
    return (F.when(parsed.isNull(),
                   F.concat(F.lit(INVALID_JSON_PREFIX),
                            F.when(~utf8, F.lit("bytes are not valid UTF-8"))
                            .otherwise(F.lit("document is not well-formed JSON"))))
            .when(~is_object(value, parsed), F.lit(NOT_OBJECT_REASON)))


def decode_payload(value: Column, parsed: Column) -> Column:
    """Dead-letter payload of a decode failure: ``{"raw_base64": ..}`` for bad
    bytes or JSON, ``{"value": ..}`` for a JSON value that is not an object."""
    return (F.when(parsed.isNull(), F.to_json(F.struct(base64_text(value).alias("raw_base64"))))
            .otherwise(F.concat(F.lit('{"value":'), F.to_json(parsed), F.lit("}"))))


def version_field(parsed: Column) -> Column:
    return F.try_variant_get(parsed, "$.schema_version", "variant")


def version_number(parsed: Column, raw: Column | None = None, kind: Column | None = None) -> Column:
    """Numeric schema version: 0 when the key is missing, NULL when it is not a
    number (JSON null, string, boolean, ...).  ``raw`` and ``kind``: columns that
    hold the version field and its type already."""
    raw = version_field(parsed) if raw is None else raw
    kind = F.schema_of_variant(raw) if kind is None else kind
    numeric = kind.rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$")
    return (F.when(raw.isNull(), F.lit(0.0))
            .when(numeric, F.try_variant_get(raw, "$", "double")))


def version_failure(parsed: Column, raw: Column | None = None, kind: Column | None = None,
                    number: Column | None = None) -> Column:
    """Reason for an unsupported version, else NULL (0 upcasts, 1 passes)."""
    raw = version_field(parsed) if raw is None else raw
    kind = F.schema_of_variant(raw) if kind is None else kind
    number = version_number(parsed, raw, kind) if number is None else number
    text = (F.when(F.is_variant_null(raw), F.lit("None"))
            .when(kind == "STRING",
                  F.concat(F.lit("'"), F.try_variant_get(raw, "$", "string"), F.lit("'")))
            .when(kind == "BOOLEAN",
                  F.when(F.try_variant_get(raw, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")))
            .otherwise(F.to_json(raw)))
    supported = number.isNotNull() & number.isin(0.0, 1.0)
    return F.when(~supported, F.concat(F.lit(UNSUPPORTED_VERSION_PREFIX), text))


def with_version(df: DataFrame, parsed: str = "_v") -> DataFrame:
    """Adds ``_raw``, ``_vkind`` and ``_ver``: the version field, its type and
    its number, each read once."""
    raw = df.withColumn("_raw", version_field(F.col(parsed))).withColumn("_vkind", F.schema_of_variant("_raw"))
    return raw.withColumn("_ver", version_number(F.col(parsed), F.col("_raw"), F.col("_vkind")))


def is_upcast(parsed: Column) -> Column:
    """True when a version-0 envelope is normalised to version 1 (schema id 0)."""
    return version_number(parsed) == 0.0
