"""Ingestion-edge jobs (S2-S4): envelope building, batch split, batch ceiling.

Requests are data: one row per submitted event with its request id and
position, or one row per request with its event array.  Validation is the
edge model's: the event id is optional (filled in), every other field is
checked like in the worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.constants import MAX_BATCH_EVENTS, SUPPORTED_SCHEMA_VERSION
from fleetline.functions import validate
from fleetline.sources import fixture

BATCH_REQUEST_SIZE = 50          # fixture: 50 consecutive events per batch request


def edge_elements(events: DataFrame) -> DataFrame:
    """Fixture edge bodies: one JSON object per source event, as a client
    posts it (missing fields and out-of-range readings included)."""
    d = fixture.fixture_events(events)
    eid = F.col("eid")
    missing = F.when(eid % 200 == 3, F.expr("(eid div 200) % 3"))
    keep = lambda n: missing.isNull() | (missing != n)
    body = F.to_json(F.struct(
        F.col("event_id"),
        F.when(keep(0), F.col("device_id")).alias("device_id"),
        F.when(keep(1), F.date_format(F.timestamp_micros("t_us"), fixture.TS_FORMAT)).alias("timestamp"),
        F.when(keep(2), F.col("temperature")).alias("temperature"),
        F.col("voltage"), F.col("status"), F.col("region")))
    return d.select("eid", "user_id", "t_us", "recv_us", body.alias("element"))


def check_elements(elements: DataFrame) -> DataFrame:
    """Adds ``errors`` (array) and the typed fields of every edge element."""
    parsed = elements.withColumn("_v", F.try_parse_json("element"))
    typed = validate.typed_fields(validate.extract_fields(parsed, "_v", event_path="$"))
    out = typed.withColumn("errors", validate.edge_event_errors())
    return out.select(*elements.columns, "errors",
                      F.coalesce(F.col("_s_event_event_id"), F.expr("uuid()")).alias("event_id"),
                      F.col("_s_event_device_id").alias("device_id"),
                      F.col("_t_event_timestamp").alias("timestamp"),
                      F.col("_n_event_temperature").alias("temperature"),
                      F.col("_n_event_voltage").alias("voltage"),
                      F.col("_s_event_status").alias("status"),
                      F.col("_s_event_region").alias("region"))


def accepted_envelopes(checked: DataFrame, schema_id: int, received_at: Column | None = None) -> DataFrame:
    """Envelopes ``{schema_version: 1, schema_id, event, received_at}`` of the
    valid elements of :func:`check_elements` (whose missing event ids became
    random UUIDs: write that frame once before reusing it)."""
    if schema_id < 1:
        raise ValueError("the edge stamps registered schema ids (>= 1)")
    checked = checked.filter(F.size("errors") == 0)
    recv = received_at if received_at is not None else F.timestamp_micros("recv_us")
    event = F.struct("event_id", "device_id", "timestamp", "temperature", "voltage", "status", "region")
    return checked.select(
        "event_id", "device_id", F.lit(SUPPORTED_SCHEMA_VERSION).alias("schema_version"),
        F.lit(schema_id).alias("schema_id"), recv.alias("received_at"),
        F.to_json(F.struct(F.lit(SUPPORTED_SCHEMA_VERSION).alias("schema_version"),
                           F.lit(schema_id).alias("schema_id"), event.alias("event"),
                           recv.alias("received_at")),
                  {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("envelope"))


def batch_requests(elements: DataFrame) -> DataFrame:
    """Fixture batch requests: ``events`` array of 50 consecutive bodies."""
    return elements.groupBy(F.expr(f"eid div {BATCH_REQUEST_SIZE}").alias("request_id")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("eid"), F.col("element")))).alias("_items")
    ).select("request_id", F.col("_items.element").alias("events"))


def split_batches(requests: DataFrame) -> DataFrame:
    """S3: accept/reject every element of a batch request by position.

    One row per request.  A request above the ceiling is rejected whole before
    it is split (``admitted`` false, every event rejected, no positions); an
    empty or null one is admitted with nothing in it.  A bad element does not
    fail the request; the rejected positions and their errors come back in
    order.  Arrays are bounded by the ceiling, so nothing unbounded is
    collected.
    """
    sized = requests.select("request_id", "events", F.coalesce(F.size("events"), F.lit(0)).cast("bigint")
                            .alias("submitted")).withColumn("admitted", F.col("submitted") <= MAX_BATCH_EVENTS)
    items = sized.select("request_id", "submitted", "admitted", F.posexplode_outer(
        F.when(F.col("admitted"), F.col("events"))).alias("position", "element"))
    checked = check_elements(items)
    there = F.col("position").isNotNull()
    bad = there & (F.size("errors") > 0)
    rejections = F.sort_array(F.collect_list(F.when(bad, F.struct(
        "position", F.array_join("errors", "; ").alias("error")))))
    split = checked.groupBy("request_id", "submitted", "admitted").agg(
        F.count_if(there & ~bad).alias("accepted"), rejections.alias("rejections"))
    return split.select(
        "request_id", "submitted", "admitted", "accepted",
        (F.col("submitted") - F.col("accepted")).alias("rejected"),
        F.array_join(F.col("rejections.position").cast("array<string>"), ",").alias("rejected_positions"),
        "rejections")


def ceiling(checked: DataFrame) -> DataFrame:
    """Hourly per-client requests (client = user % 7) over checked elements;
    a request of more than 500 events is rejected whole (counted on the
    submitted size)."""
    per = checked.groupBy((F.col("user_id") % 7).alias("client"),
                          F.expr("t_us div 3600000000").alias("hour")).agg(
        F.count(F.lit(1)).alias("submitted"), F.count_if(F.size("errors") == 0).alias("valid"))
    admitted = F.col("submitted") <= MAX_BATCH_EVENTS
    return per.select("client", "hour", "submitted", admitted.alias("admitted"),
                      F.when(admitted, F.col("valid")).otherwise(F.lit(0)).cast("bigint").alias("accepted"))
