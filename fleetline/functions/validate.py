"""Field validation of a (normalised) envelope, as Column expressions.

Every rule yields ``'<field>: <code>'`` or NULL; all failing rules are kept
(not only the first), like a model validator that reports every error.
Strings must be JSON strings; numbers may be JSON numbers or numeric
strings (lenient coercion); booleans are never numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.constants import (
    DEVICE_ID_MAX_LEN, ENVELOPE_KEYS_V0, ENVELOPE_KEYS_V1, EVENT_ID_MAX_LEN, EVENT_KEYS,
    REGION_MAX_LEN, STATUSES, TEMPERATURE_MAX, TEMPERATURE_MIN, VOLTAGE_MAX, VOLTAGE_MIN,
)

# --- fixed values: accepted ISO-8601 date-time shape -------------------------
ISO_DATETIME = (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
                r"(Z|z|[+-]\d{2}(:?\d{2})?)?$")
NUMERIC_KINDS = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"
INTEGRAL_KINDS = r"^(TINYINT|SMALLINT|INT|BIGINT)$"
NUMERIC_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_TEXT = r"^\s*([+-]?\d+)(?:\.0*)?\s*$"


FIELDS = {
    "schema_id": "$.schema_id",
    "event": "$.event",
    "received_at": "$.received_at",
    "event.event_id": "$.event.event_id",
    "event.device_id": "$.event.device_id",
    "event.timestamp": "$.event.timestamp",
    "event.temperature": "$.event.temperature",
    "event.voltage": "$.event.voltage",
    "event.status": "$.event.status",
    "event.region": "$.event.region",
}


def _slot(name: str) -> str:
    return "_f_" + name.replace(".", "_")


def _kind(name: str) -> str:
    return "_k_" + name.replace(".", "_")


def extract_fields(df: DataFrame, parsed: str = "_v", event_path: str = "$.event") -> DataFrame:
    """Stage 1+2: every contract field once as a variant, then its type name
    (NULL when the key is missing, ``VOID`` for JSON null).  ``event_path``
    is ``"$"`` for a bare event (the ingestion edge)."""
    def path_of(p: str) -> str:
        return p if not p.startswith("$.event") else event_path + p[len("$.event"):]
    fields = df.select("*", *[F.try_variant_get(F.col(parsed), path_of(path), "variant").alias(_slot(n))
                              for n, path in FIELDS.items()])
    # Of the event only that it is an object matters: its whole type is long.
    is_object = F.try_variant_get(F.col(_slot("event")), "$", "map<string,variant>").isNotNull()
    kinds = {n: F.schema_of_variant(_slot(n)) for n in FIELDS}
    kinds["event"] = F.when(is_object, F.lit("OBJECT")).otherwise(kinds["event"])
    return fields.select("*", *[kind.alias(_kind(n)) for n, kind in kinds.items()])


def _missing(name: str) -> Column:
    return F.col(_kind(name)).isNull() | (F.col(_kind(name)) == "VOID")


def _string(name: str) -> Column:
    return F.when(F.col(_kind(name)) == "STRING", F.try_variant_get(F.col(_slot(name)), "$", "string"))


def _number(name: str) -> Column:
    numeric = _string(name).rlike(NUMERIC_TEXT)     # the cast alone takes suffixes such as 72.4d
    return F.when(F.col(_kind(name)).rlike(NUMERIC_KINDS) | numeric,
                  F.try_variant_get(F.col(_slot(name)), "$", "double"))


def _integer(name: str) -> Column:
    """JSON integers, and numbers or numeric strings without a fraction."""
    k, slot, text = F.col(_kind(name)), F.col(_slot(name)), _string(name)
    real = F.try_variant_get(slot, "$", "double")
    return (F.when(k.rlike(INTEGRAL_KINDS) | (k.rlike(NUMERIC_KINDS) & (real == F.rint(real))),
                   F.try_variant_get(slot, "$", "bigint"))
            .when(text.rlike(INTEGER_TEXT), F.regexp_extract(text, INTEGER_TEXT, 1).try_cast("bigint")))


def _timestamp(text: Column) -> Column:
    return F.when(text.rlike(ISO_DATETIME), text.try_cast("timestamp"))


def typed_fields(df: DataFrame) -> DataFrame:
    """Stage 3: typed candidate values (NULL when the type is wrong)."""
    strings = ["event.event_id", "event.device_id", "event.status", "event.region",
               "event.timestamp", "received_at"]
    numbers = ["event.temperature", "event.voltage"]
    staged = df.select("*", *[_string(n).alias("_s_" + _slot(n)[3:]) for n in strings],
                       *[_number(n).alias("_n_" + _slot(n)[3:]) for n in numbers],
                       _integer("schema_id").alias("_n_schema_id"))
    return staged.select("*", _timestamp(F.col("_s_event_timestamp")).alias("_t_event_timestamp"),
                         _timestamp(F.col("_s_received_at")).alias("_t_received_at"))


def _rule(name: str, code: str, failed: Column) -> Column:
    return F.when(failed, F.lit(f"{name}: {code}"))


def _string_rules(name: str, min_len: int, max_len: int) -> list[Column]:
    text = F.col("_s_" + _slot(name)[3:])
    return [
        _rule(name, "field required", _missing(name)),
        _rule(name, "input should be a valid string", ~_missing(name) & text.isNull()),
        _rule(name, f"length should be between {min_len} and {max_len}",
              text.isNotNull() & ~F.length(text).between(min_len, max_len)),
    ]


def _number_rules(name: str, low: float, high: float) -> list[Column]:
    number = F.col("_n_" + _slot(name)[3:])
    return [
        _rule(name, "field required", _missing(name)),
        _rule(name, "input should be a valid number", ~_missing(name) & number.isNull()),
        _rule(name, f"input should be between {low:g} and {high:g}",
              number.isNotNull() & ~(number.between(low, high) & ~F.isnan(number))),
    ]


def _timestamp_rules(name: str) -> list[Column]:
    return [
        _rule(name, "field required", _missing(name)),
        _rule(name, "input should be a valid datetime",
              ~_missing(name) & F.col("_t_" + _slot(name)[3:]).isNull()),
    ]


def envelope_errors(upcast: Column) -> Column:
    """Array of all rule violations of a version-0/1 envelope (empty = valid).

    Reads the columns of :func:`extract_fields` and :func:`typed_fields`;
    ``upcast`` marks version-0 envelopes whose ``schema_id`` becomes 0.
    """
    schema_id = F.col("_n_schema_id")
    rules = [
        _rule("schema_id", "field required", ~upcast & _missing("schema_id")),
        _rule("schema_id", "input should be a valid integer",
              ~upcast & ~_missing("schema_id") & schema_id.isNull()),
        _rule("schema_id", "input should be greater than or equal to 0",
              ~upcast & (schema_id < 0)),
        _rule("event", "field required", _missing("event")),
        _rule("event", "input should be an object",
              ~_missing("event") & ~F.col(_kind("event")).startswith("OBJECT")),
        *_timestamp_rules("received_at"),
        *_string_rules("event.event_id", 1, EVENT_ID_MAX_LEN),
        *_string_rules("event.device_id", 1, DEVICE_ID_MAX_LEN),
        *_timestamp_rules("event.timestamp"),
        *_number_rules("event.temperature", TEMPERATURE_MIN, TEMPERATURE_MAX),
        *_number_rules("event.voltage", VOLTAGE_MIN, VOLTAGE_MAX),
        _rule("event.status", "field required", _missing("event.status")),
        _rule("event.status", "input should be 'OK', 'WARNING' or 'FAILED'",
              ~_missing("event.status")
              & ~F.coalesce(F.col("_s_event_status").isin(*STATUSES), F.lit(False))),
        *_string_rules("event.region", 1, REGION_MAX_LEN),
    ]
    return F.array_compact(F.array(*rules))


def edge_event_errors() -> Column:
    """Rule violations of a bare event at the ingestion edge (the event id is
    optional there: a missing one is filled in, an explicit null is an error)."""
    rules = [
        _rule("event_id", "input should be a valid string",
              F.col(_kind("event.event_id")).isNotNull() & F.col("_s_event_event_id").isNull()),
        *[r for r in _string_rules("event.device_id", 1, DEVICE_ID_MAX_LEN)],
        *_timestamp_rules("event.timestamp"),
        *_number_rules("event.temperature", TEMPERATURE_MIN, TEMPERATURE_MAX),
        *_number_rules("event.voltage", VOLTAGE_MIN, VOLTAGE_MAX),
        _rule("event.status", "field required", _missing("event.status")),
        _rule("event.status", "input should be 'OK', 'WARNING' or 'FAILED'",
              ~_missing("event.status")
              & ~F.coalesce(F.col("_s_event_status").isin(*STATUSES), F.lit(False))),
        *_string_rules("event.region", 1, REGION_MAX_LEN),
    ]
    return F.array_compact(F.array(*rules))


def event_fields(upcast: Column) -> list[Column]:
    """Typed columns of a valid envelope (meaningful only when errors are empty)."""
    return [
        F.when(upcast, F.lit(0)).otherwise(F.col("_n_schema_id")).cast("bigint").alias("schema_id"),
        F.col("_s_event_event_id").alias("event_id"),
        F.col("_s_event_device_id").alias("device_id"),
        F.col("_t_event_timestamp").alias("timestamp"),
        F.col("_n_event_temperature").alias("temperature"),
        F.col("_n_event_voltage").alias("voltage"),
        F.col("_s_event_status").alias("status"),
        F.col("_s_event_region").alias("region"),
        F.col("_t_received_at").alias("received_at"),
    ]


def contract_violations(parsed: Column, version: Column) -> Column:
    """Strict contract rules of the published JSON schemas (v0 and v1).

    On top of :func:`envelope_errors`: no keys outside the contract (envelope
    and event), ``schema_version`` exactly 1 and ``schema_id >= 1`` for v1, and
    no number written as a string (or null).  ``version`` is the *declared*
    version (0 when absent); reads the columns of :func:`extract_fields`.
    """
    keys = F.map_keys(F.try_variant_get(parsed, "$", "map<string,variant>"))
    event_keys = F.map_keys(F.try_variant_get(parsed, "$.event", "map<string,variant>"))
    allowed = F.when(version == 0, F.array(*[F.lit(k) for k in ENVELOPE_KEYS_V0])) \
        .otherwise(F.array(*[F.lit(k) for k in ENVELOPE_KEYS_V1]))
    extra = F.array_except(keys, allowed)
    extra_event = F.array_except(F.coalesce(event_keys, F.array().cast("array<string>")),
                                 F.array(*[F.lit(k) for k in EVENT_KEYS]))
    schema_id = F.try_variant_get(parsed, "$.schema_id", "bigint")
    strict = [
        F.when(F.size(extra) > 0, F.concat(F.lit("additional properties: "), F.array_join(extra, ","))),
        F.when(F.size(extra_event) > 0,
               F.concat(F.lit("event additional properties: "), F.array_join(extra_event, ","))),
        F.when((version == 1) & schema_id.isNotNull() & (schema_id < 1),
               F.lit("schema_id: must be >= 1")),
        *[F.when(F.col(_kind(n)).isin("STRING", "VOID"), F.lit(f"{n}: must be a JSON number"))
          for n in ("schema_id", "event.temperature", "event.voltage")],
    ]
    return F.array_compact(F.array(*strict))
