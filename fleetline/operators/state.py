"""State tables derived from stored events.

All of them are associative re-aggregations, so the same function serves a
one-shot batch and an incremental (micro-batch) update: union the current
state with the new rows and aggregate again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetline.constants import CACHE_TTL_SECONDS, RECENT_LIST_SIZE, VALIDATED_TOPIC
from fleetline.operators.sequence import top_k_per_group

STATUS_COLUMNS = ["device_id", "region", "last_seen", "status", "temperature", "voltage"]
VALIDATED_FIELDS = ["event_id", "device_id", "timestamp", "avg_temperature_5m",
                    "voltage_drop_detected", "event_lag_ms", "outlier_detected"]


def device_status(events: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Latest state per device: last writer by (event time, arrival) wins.

    A later arrival with an equal timestamp replaces the state; an older
    event never does.  ``current`` is an earlier result of this function
    (kept with its ``_winner`` column) to fold a new batch into.
    """
    rows = events.select(
        "device_id",
        F.struct(F.col("timestamp").alias("last_seen"), "source_partition", "source_offset",
                 "arrival_ts", "region", "status", "temperature", "voltage").alias("_winner"))
    if current is not None:
        rows = rows.unionByName(current.select("device_id", "_winner"))
    folded = rows.groupBy("device_id").agg(F.max("_winner").alias("_winner"))
    return folded.select("device_id", "_winner.region", "_winner.last_seen", "_winner.status",
                         "_winner.temperature", "_winner.voltage", "_winner")


def touches(valid: DataFrame, stored: DataFrame) -> DataFrame:
    """Last touch of every stored event: the latest valid delivery of its id.

    A duplicate delivery re-touches the stored row (the cached list moves it
    to the front); the device is the stored row's device.
    """
    last = valid.groupBy("event_id").agg(
        F.max(F.struct("source_partition", "source_offset", "arrival_ts")).alias("last_touch"))
    return stored.join(last, "event_id")


def recent_events(valid: DataFrame, stored: DataFrame, now: Column | None = None,
                  size: int = RECENT_LIST_SIZE, salts: int = 16) -> DataFrame:
    """The per-device recent list: newest ``size`` stored events by last touch.

    Lists whose device was last touched more than 24 h before ``now`` have
    expired.  Ranked in two passes (salted, then per device) so one hot
    device is not ranked in one task.
    """
    touched = touches(valid, stored)
    order = [F.col("last_touch").desc(), F.col("event_id").desc()]
    ranked = top_k_per_group(touched, ["device_id"], order, size,
                             salt=F.pmod(F.hash("event_id"), F.lit(salts)), rank_col="position")
    if now is not None:
        device_touch = Window.partitionBy("device_id")
        ranked = ranked.withColumn("_device_touch", F.max("last_touch.arrival_ts").over(device_touch))
        ranked = ranked.filter(F.col("_device_touch") > now - F.expr(f"INTERVAL {CACHE_TTL_SECONDS} SECONDS"))
        ranked = ranked.drop("_device_touch")
    return ranked


def iso_utc(ts: Column) -> Column:
    """ISO 8601 in UTC with ``Z``; a fraction (six digits) only if there is one."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(F.unix_micros(ts) % 1000000 == 0, "").otherwise(F.date_format(ts, ".SSSSSS")), F.lit("Z"))


def validated_payload() -> Column:
    """The validated record's JSON: seven fields."""
    return F.to_json(F.struct(*[iso_utc(F.col(c)).alias(c) if c == "timestamp" else F.col(c)
                                for c in VALIDATED_FIELDS]))


def ledger_rows(inserted: DataFrame, *keep: str, topic: str = VALIDATED_TOPIC) -> DataFrame:
    """Delivery-ledger rows written with the inserted events (one per id).
    ``keep``: further columns to carry."""
    return inserted.select(
        "event_id", F.lit(topic).alias("topic"), F.col("device_id").alias("message_key"),
        validated_payload().alias("payload"), F.col("processed_at").alias("created_at"), *keep)


def ledger_times(inserted: DataFrame) -> DataFrame:
    """When each row of :func:`ledger_rows` is written; needs no enriched column."""
    return inserted.select("event_id", F.col("processed_at").alias("created_at"))


def ledger_with_acks(ledger: DataFrame, acks: DataFrame) -> DataFrame:
    """Ledger rows with ``published_at`` from the acknowledgement log (earliest ack)."""
    first_ack = acks.groupBy("event_id").agg(F.min("published_at").alias("published_at"))
    return ledger.join(first_ack, "event_id", "left")


def pending(ledger: DataFrame, acks: DataFrame) -> DataFrame:
    """Ledger rows not yet acknowledged (anti-join, not ``NOT IN``)."""
    return ledger.join(acks.select("event_id"), "event_id", "left_anti")
