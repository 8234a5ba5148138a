"""Decode, normalise, validate and route raw deliveries (V1-V6).

One pass produces one frame with a ``reason`` column: NULL for a valid
envelope, the dead-letter reason otherwise.  Exactly one outcome per
delivery; a bad record never blocks the others.  Callers that write both
branches should persist the routed frame (a micro-batch) or write it once
and split on ``reason``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.functions import decode, validate

VALIDATION_PREFIX = "validation failed: "


def route(deliveries: DataFrame, processing_time: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Route a delivery log (``key, value, topic, partition, offset, timestamp``).

    ``processing_time`` gives the processing instant per delivery; by default
    the query's ``current_timestamp()``.
    """
    parsed = deliveries.select(
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("int").alias("source_partition"),
        F.col("offset").cast("bigint").alias("source_offset"),
        F.col("timestamp").alias("arrival_ts"),
        F.col("value"),
        decode.parse_message(F.col("value")).alias("_v"),
    )
    v = F.col("_v")
    staged = decode.with_version(parsed.select(
        "*",
        decode.decode_failure(F.col("value"), v).alias("_decode"),
    )).select(
        "*",
        F.when(F.col("_decode").isNull(), decode.version_failure(v, F.col("_raw"), F.col("_vkind"), F.col("_ver")))
        .alias("_version"),
        F.when(F.col("_decode").isNull(), F.col("_ver") == 0.0).alias("_upcast"),
    )
    upcast = F.coalesce(F.col("_upcast"), F.lit(False))
    typed = validate.typed_fields(validate.extract_fields(staged, "_v"))
    checked = typed.select(
        "*",
        F.when(F.col("_decode").isNull() & F.col("_version").isNull(),
               validate.envelope_errors(upcast)).alias("errors"),
        *validate.event_fields(upcast),
    )
    reason = F.coalesce(
        F.col("_decode"), F.col("_version"),
        F.when(F.size("errors") > 0, F.concat(F.lit(VALIDATION_PREFIX), F.array_join("errors", "; "))))
    payload = F.when(F.col("_decode").isNotNull(), decode.decode_payload(F.col("value"), v)) \
        .otherwise(F.to_json(v))
    routed = checked.select(
        "source_topic", "source_partition", "source_offset", "arrival_ts",
        reason.alias("reason"),
        F.when(reason.isNotNull(), payload).alias("payload"),
        F.when(reason.isNotNull(), F.col("errors")).alias("errors"),
        F.when(reason.isNull(), upcast).alias("upcast"),
        "schema_id", "event_id", "device_id", "timestamp", "temperature", "voltage",
        "status", "region", "received_at",
    )
    pt = processing_time(routed) if processing_time else F.current_timestamp()
    return routed.withColumn("processed_at", pt)


def decided(routed: DataFrame) -> DataFrame:
    """``routed`` with its outcome computed before it is filtered by.  For routed
    frames that are not written first: the optimizer would push the filter
    under the routing and repeat decoding in it for every field of every rule.
    It leaves a filter above a column that counts as not deterministic."""
    return routed.withColumn("reason", F.when(F.spark_partition_id() >= 0, F.col("reason")))


def valid_deliveries(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("reason").isNull()).drop("reason", "payload", "errors")


def failed_deliveries(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("reason").isNotNull()).select(
        "source_topic", "source_partition", "source_offset", "arrival_ts", "payload", "reason",
        "errors", "processed_at")
