"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each entry reads the driver's tables through the fixture catalog, runs one
operator or query of the engine, and returns a comparison-friendly frame
(timestamps as epoch microseconds, doubles rounded to 6 digits).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetline.operators.enrich import EVENT_COLUMNS
from fleetline.plans.catalog import catalog, present

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(catalog(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return wrap


@register("enriched_events")
def enriched_events(c):
    """The fully enriched stored event rows (flagship)."""
    return c.events.select(*EVENT_COLUMNS)


# --- E1-E6: single enrichment columns and storage ---------------------------

@register("event_lag")
def event_lag(c):
    """Processing minus event time in ms, truncated toward zero."""
    return c.events.select("event_id", "timestamp", "processed_at", "event_lag_ms")


@register("outlier_flag")
def outlier_flag(c):
    """Temperature outside (-40, 140), strict."""
    return c.events.select("event_id", "temperature", "outlier_detected")


@register("voltage_drop")
def voltage_drop(c):
    """Drop of 2.5 or more against the newest earlier-arrived reading."""
    return c.events.select("event_id", "device_id", "voltage", "voltage_drop_detected")


@register("avg_temperature_5m")
def avg_temperature_5m(c):
    """Trailing 5-minute mean over earlier arrivals (own value if none)."""
    return c.events.select("event_id", "device_id", "timestamp", "temperature", "avg_temperature_5m")


@register("dedup_first")
def dedup_first(c):
    """E5: the stored (first) delivery of every event id."""
    return c.events.select("event_id", "device_id", "source_partition", "source_offset", "arrival_ts")


@register("duplicate_counts")
def duplicate_counts(c):
    """Valid deliveries per re-delivered event id and the ignored duplicates."""
    from pyspark.sql import functions as F
    return (c.ingest.valid.groupBy("event_id").agg(F.count(F.lit(1)).alias("deliveries"))
            .filter("deliveries > 1").withColumn("duplicates", F.col("deliveries") - 1))


# --- T1-T8: state tables ------------------------------------------------------

@register("device_status")
def device_status_q(c):
    """Last-writer-wins device state."""
    return c.status.select("device_id", "region", "last_seen", "status", "temperature", "voltage")


@register("recent_50")
def recent_50(c):
    """Per-device recent list by last touch (50 newest, 24 h expiry)."""
    from fleetline.operators.state import recent_events
    return recent_events(c.ingest.valid, c.events, now=c.params.now).select(
        "device_id", "event_id", "position")


@register("latest_touched")
def latest_touched(c):
    """The cached latest value per device (last touched stored row)."""
    from fleetline.operators.state import recent_events
    return recent_events(c.ingest.valid, c.events, now=c.params.now, size=1).select(
        "device_id", "event_id", "timestamp", "temperature", "voltage")


@register("recent_50_stream")
def recent_50_stream(c):
    """T2 + T3 from stream state: the log in three micro-batches."""
    from fleetline.sources.fixture import BASE_US
    from fleetline.streaming.recent import replayed
    from pyspark.sql import functions as F
    thirds = [(None, 2), (2, 4), (4, None)]            # hours after the fixture's start
    return replayed(c.spark, c.deliveries, F.timestamp_micros(F.lit(BASE_US)), thirds, "INTERVAL {} HOURS").select(
        "device_id", "event_id", "position")


@register("ledger_insert")
def ledger_insert(c):
    """T4: one delivery-ledger row per inserted event."""
    return c.ingest.ledger.select("event_id", "topic", "message_key", "created_at")


@register("ledger_pending")
def ledger_pending(c):
    """T5: the oldest 100 pending ledger rows (a dispatcher claim)."""
    from fleetline.plans.ledger import claim_pending
    return claim_pending(c.ingest.ledger, c.acks, 100).select("event_id", "message_key", "created_at")


@register("ledger_after_publish")
def ledger_after_publish(c):
    """Ledger after acknowledgements: published rows carry their ack time."""
    return c.ledger.select("event_id", "created_at", "published_at")


@register("ledger_backlog")
def ledger_backlog(c):
    """Pending count and age of the oldest pending row at ``now``."""
    from fleetline.plans.ledger import backlog
    return backlog(c.ledger, c.params.now)


@register("partition_lag")
def partition_lag(c):
    """Consumer lag per source partition at a probe instant."""
    from fleetline.plans.ledger import partition_lag as lag
    return lag(c.ingest.routed, c.params.cutoff)


# --- Q1-Q13: read queries -------------------------------------------------------

@register("devices_by_region")
def devices_by_region(c):
    """Q1 with region = us-east."""
    from fleetline.plans import queries as Q
    return Q.devices(c.status, "us-east")


@register("device_history")
def device_history(c):
    """Q2 for sensor-00001, hours 1-5, limit 500."""
    from fleetline.plans import queries as Q
    from fleetline.sources.fixture import BASE_US
    from pyspark.sql import functions as F
    h = 3600 * 1000000
    return Q.device_history(c.events, "sensor-00001", F.timestamp_micros(F.lit(BASE_US + h)),
                            F.timestamp_micros(F.lit(BASE_US + 5 * h)), None, 500)


@register("latest_per_device")
def latest_per_device(c):
    """Q3 fleet-wide."""
    from fleetline.plans import queries as Q
    return Q.latest_per_device(c.events)


@register("pipeline_stats")
def pipeline_stats(c):
    """Q5 with prefix ``sensor_0001`` (the underscore is a wildcard)."""
    from fleetline.plans import queries as Q
    return Q.pipeline_stats(c.events, c.dead_letters, c.ledger, "sensor_0001")


@register("status_counts")
def status_counts(c):
    from fleetline.plans import queries as Q
    return Q.status_counts(c.status)


@register("region_health")
def region_health(c):
    from fleetline.plans import queries as Q
    return Q.region_health(c.status)


@register("minute_trend")
def minute_trend(c):
    from fleetline.plans import queries as Q
    return Q.minute_trend(c.events)


@register("last_trend")
def last_trend(c):
    """Q13: the trend's last bucket, a dashboard tile."""
    from fleetline.plans import queries as Q
    from pyspark.sql import functions as F
    return Q.minute_trend(c.events).orderBy(F.desc("bucket")).limit(1)


@register("latest_seen_devices")
def latest_seen_devices(c):
    from fleetline.plans import queries as Q
    return Q.latest_seen_devices(c.status)


@register("reliability_scalars")
def reliability_scalars(c):
    from fleetline.plans import queries as Q
    return Q.reliability_scalars(c.events, c.dead_letters, c.replays, c.ledger, c.status, c.params.now)


@register("region_summary")
def region_summary(c):
    """Q11 for every region of the fleet plus one region without devices."""
    from fleetline.plans import queries as Q
    from pyspark.sql import functions as F
    asked = c.status.select("region").union(
        c.status.sparkSession.range(1).select(F.lit("ap-north").alias("region")))
    return Q.region_summary(c.events, asked, c.params.now)


@register("alerts")
def alerts(c):
    from fleetline.plans import queries as Q
    return Q.alerts(c.events, 100)


@register("fleet_summary")
def fleet_summary(c):
    from fleetline.plans import queries as Q
    return Q.fleet_summary(c.status)


@register("incident_list")
def incident_list(c):
    from fleetline.plans import queries as Q
    return Q.incident_list(c.events)


# --- L1-L6: dead-letter triage and replay --------------------------------------

@register("dlq_list")
def dlq_list(c):
    from fleetline.plans import deadletter as L
    return L.list_errors(c.dead_letters, c.replays, 20)


@register("dlq_by_reason")
def dlq_by_reason(c):
    from fleetline.plans import deadletter as L
    return L.by_reason(c.dead_letters)


@register("dlq_restore")
def dlq_restore(c):
    from fleetline.plans import deadletter as L
    from pyspark.sql import functions as F
    r = L.restore(c.dead_letters)
    return r.select(*L.COORDS, "restore_kind", "replay_key",
                    F.when(F.col("restore_kind") == "raw", F.length("replay_bytes")).alias("raw_bytes"),
                    F.when(F.col("restore_kind") == "raw", F.col("replay_bytes").cast("string"))
                    .alias("raw_text"))


@register("dlq_replay_plan")
def dlq_replay_plan(c):
    """L5 for every dead letter plus one coordinate that does not exist."""
    from fleetline.plans import deadletter as L
    from pyspark.sql import functions as F
    asked = c.dead_letters.select(*L.COORDS)
    missing = asked.sparkSession.range(1).select(
        F.lit("raw-telemetry").alias("source_topic"), F.lit(0).alias("source_partition"),
        F.lit(-1).cast("bigint").alias("source_offset"))
    return L.replay_plan(c.dead_letters, c.replays, asked.unionByName(missing)).select(
        *L.COORDS, "found", "next_replay_count", "executed",
        F.split("reason", ":").getItem(0).alias("reason_class"))


@register("dlq_after_replay")
def dlq_after_replay(c):
    from fleetline.plans import deadletter as L
    return L.with_replays(c.dead_letters, c.replays).select(*L.COORDS, "replay_count", "replayed_at")


# --- R1-R6: retention and hourly roll-up -----------------------------------------

@register("retention_inspect")
def retention_inspect(c):
    from fleetline.plans import retention as RT
    return RT.inspect(c.events, c.ledger, c.params.cutoff)


@register("retention_batch")
def retention_batch(c):
    """R2 with a batch of 1000 (the batch bound is the feature)."""
    from fleetline.plans import retention as RT
    return RT.select_batch(c.events, c.ledger, c.params.cutoff, 1000).select("event_id", "timestamp")


@register("hourly_rollup")
def hourly_rollup(c):
    """R3 over every stored event."""
    from fleetline.plans import retention as RT
    return RT.exposed(RT.rollup(c.events))


@register("rollup_merge")
def rollup_merge(c):
    """Eligible events rolled up in two batches (first 1000, then the rest), merged."""
    from fleetline.plans import retention as RT
    from fleetline.plans.catalog import write_table
    eligible = write_table(RT.select_batch(c.events, c.ledger, c.params.cutoff, None), "retention-eligible")
    first = eligible.orderBy("timestamp", "event_id").limit(1000)
    rest = eligible.join(first.select("event_id"), "event_id", "left_anti")
    return RT.exposed(RT.merge(RT.rollup(first), RT.rollup(rest)))


@register("retention_remaining")
def retention_remaining(c):
    """Rows left in the event table and the ledger after one full pass."""
    from fleetline.plans import retention as RT
    from pyspark.sql import functions as F
    r = RT.run(c.events, c.ledger, None, c.params.cutoff, None, execute=True)
    return (r.events.agg(F.lit("telemetry_events").alias("table_name"), F.count(F.lit(1)).alias("rows"))
            .unionByName(r.ledger.agg(F.lit("event_outbox").alias("table_name"), F.count(F.lit(1)).alias("rows"))))


@register("retention_report")
def retention_report(c):
    """Report of an executed pass with a batch bound of 1000."""
    from fleetline.plans import retention as RT
    from fleetline.plans.catalog import write_table
    return RT.run(c.events, c.ledger, None, c.params.cutoff, 1000, execute=True, materialize=write_table).report


# --- V1-V7: decode, normalise, validate, route ---------------------------------

def _outcome():
    from pyspark.sql import functions as F
    r = F.col("reason")
    return (F.when(r.isNull(), "processed")
            .when(r.startswith("invalid JSON"), "invalid_json")
            .when(r == "payload must be a JSON object", "not_object")
            .when(r.startswith("unsupported schema_version"), "unsupported_version")
            .otherwise("invalid_fields"))


@register("decode_route")
def decode_route(c):
    """V1: decode outcome per delivery; the restorable payload of undecodable bytes."""
    from pyspark.sql import functions as F
    r = c.ingest.routed
    kind = F.when(F.col("reason").startswith("invalid JSON"), "invalid_json") \
        .when(F.col("reason") == "payload must be a JSON object", "not_object").otherwise("object")
    return r.select("source_partition", "source_offset", kind.alias("decode_outcome"),
                    F.when(kind == "invalid_json", F.col("payload")).alias("payload"))


@register("schema_upcast")
def schema_upcast(c):
    """V2: declared version, normalised schema id, upcast flag, version reason."""
    from fleetline.functions import decode
    from pyspark.sql import functions as F
    d = c.deliveries.select(F.col("partition").alias("source_partition"),
                            F.col("offset").alias("source_offset"),
                            decode.parse_message(F.col("value")).alias("_v"))
    obj = d.filter(F.schema_of_variant("_v").startswith("OBJECT"))
    v = F.col("_v")
    upcast = decode.is_upcast(v)
    return obj.select(
        "source_partition", "source_offset",
        decode.version_number(v).cast("bigint").alias("declared_version"),
        F.coalesce(upcast, F.lit(False)).alias("upcast"),
        F.when(upcast, F.lit(0)).otherwise(F.try_variant_get(v, "$.schema_id", "bigint")).alias("schema_id"),
        decode.version_failure(v).alias("version_reason"))


@register("validate_fields")
def validate_fields(c):
    """V3-V5: every field error of the envelopes that failed validation."""
    from pyspark.sql import functions as F
    r = c.ingest.routed.filter(F.col("reason").startswith("validation failed"))
    return r.select("source_partition", "source_offset", F.array_join("errors", "; ").alias("errors"))


@register("route_counts")
def route_counts(c):
    """V6: exactly one outcome per delivery."""
    from pyspark.sql import functions as F
    return c.ingest.routed.groupBy(_outcome().alias("outcome")).agg(F.count(F.lit(1)).alias("deliveries"))


@register("contract_conformance")
def contract_conformance(c):
    """V7: strict contract report per declared version (JSON schemas v0/v1)."""
    from fleetline.plans.contracts import conformance
    return conformance(c.deliveries)


# --- S1-S8: sources and sinks ------------------------------------------------------

@register("raw_deliveries")
def raw_deliveries(c):
    """The raw log as the stream source delivers it."""
    from pyspark.sql import functions as F
    return c.deliveries.select(F.col("key").cast("string").alias("key"), "topic", "partition", "offset", "timestamp")


@register("envelope_build")
def envelope_build(c):
    """Edge envelopes (schema id 1, receipt stamp) of the accepted edge events."""
    from fleetline.plans.edge import accepted_envelopes
    from pyspark.sql import functions as F
    env = accepted_envelopes(c.edge_checked, schema_id=1)
    return env.select("event_id", "device_id", "schema_version", "schema_id", "received_at",
                      F.get_json_object("envelope", "$.event.status").alias("envelope_status"))


@register("batch_accept_reject")
def batch_accept_reject(c):
    """S3: per batch request: accepted, rejected and the rejected positions."""
    from fleetline.plans.edge import batch_requests, edge_elements, split_batches
    return split_batches(batch_requests(edge_elements(c.table("events")))).drop("rejections")


@register("batch_ceiling")
def batch_ceiling(c):
    """Whole-request rejection above 500 events (hourly per-client requests)."""
    from fleetline.plans.edge import ceiling
    return ceiling(c.edge_checked)


@register("event_store")
def event_store(c):
    """Insert-if-absent over two runs (deliveries before / after hour 3)."""
    from fleetline.plans.pipeline import incremental_store
    from pyspark.sql import functions as F
    cut = c.params.cutoff
    valid = c.ingest.valid
    store = incremental_store(valid.filter(F.col("arrival_ts") < cut), None, 0)
    store = incremental_store(valid.filter(F.col("arrival_ts") >= cut), store, 1)
    return store.select("event_id", "device_id", "source_partition", "source_offset", "batch_id")


@register("validated_projection")
def validated_projection(c):
    """The validated stream record: 7 fields, key = device, header = event id."""
    from fleetline.operators.state import VALIDATED_FIELDS
    from pyspark.sql import functions as F
    return c.events.select(*VALIDATED_FIELDS, F.col("device_id").alias("message_key"),
                           F.col("event_id").alias("header_event_id"))


@register("dead_letter_upsert")
def dead_letter_upsert(c):
    """Dead letters keyed by coordinates after the batch was processed twice
    (a rewind): first payload and creation kept, latest reason, stream key."""
    from fleetline.plans.pipeline import dead_letter_rows
    from fleetline.operators.route import failed_deliveries
    from pyspark.sql import functions as F
    failed = failed_deliveries(c.ingest.routed)
    again = failed.withColumn("processed_at", F.col("processed_at") + F.expr("INTERVAL 30 SECONDS")) \
        .withColumn("reason", F.concat(F.col("reason"), F.lit(" (retry)")))
    rows = dead_letter_rows(failed.unionByName(again))
    return rows.select("source_topic", "source_partition", "source_offset", "reason", "created_at",
                       F.concat_ws(":", "source_topic", "source_partition", "source_offset").alias("stream_key"))


# --- M1-M6: metrics and SLO rules -------------------------------------------------

@register("pipeline_counters")
def pipeline_counters(c):
    from fleetline.plans import slo
    return slo.counters(c.deliveries, c.ingest.valid, c.events, c.dead_letters)


@register("latency_histogram")
def latency_histogram(c):
    from fleetline.plans import slo
    return slo.latency_histogram(c.stored).select("le", "count")


@register("latency_quantile")
def latency_quantile(c):
    from fleetline.plans import slo
    h = slo.latency_histogram(c.stored)
    return slo.histogram_quantile(h, 0.5).unionByName(slo.histogram_quantile(h, 0.95)) \
        .unionByName(slo.histogram_quantile(h, 0.99))


@register("event_rate")
def event_rate(c):
    from fleetline.plans import slo
    return slo.event_rate(c.stored)


@register("dlq_ratio")
def dlq_ratio(c):
    from fleetline.plans import slo
    return slo.dlq_ratio(c.stored, c.dead_letters)


@register("alert_states")
def alert_states(c):
    """M6: DLQ-ratio and outbox-stall rules evaluated every minute from the
    fixture start to ``now``."""
    from fleetline.constants import ALERT_RULES
    from fleetline.plans import slo
    from fleetline.sources.fixture import BASE_US
    from pyspark.sql import functions as F
    grid = slo.minute_grid(F.timestamp_micros(F.lit(BASE_US)), c.params.now, c.stored)
    samples = slo.dlq_ratio_samples(c.stored, c.dead_letters, grid).unionByName(
        slo.oldest_pending_samples(c.ledger_times, grid))
    rules = [(name, metric, op, thr, hold) for name, metric, _agg, op, thr, hold in ALERT_RULES
             if metric in ("dead_letter_ratio", "outbox_oldest_pending_seconds")]
    return slo.alert_states(samples, rules)


@register("alert_rules")
def alert_rules(c):
    """M6 + M7: all six rules every minute, over samples derived from the tables
    (readiness and a consumer stall as FIXTURES.md describes them)."""
    from fleetline.constants import ALERT_RULES
    from fleetline.plans import slo
    from fleetline.sources import fixture
    from pyspark.sql import functions as F
    grid = slo.minute_grid(F.timestamp_micros(F.lit(fixture.BASE_US)), c.params.now, c.stored)
    lag = slo.lag_samples(fixture.stalled(c.ingest.routed), grid).select(
        F.lit("queue_lag").alias("metric"), "ts", F.col("lag").cast("double").alias("value"))
    restart = F.lit(fixture.BASE_US // 60000000 + fixture.NOT_READY_MINUTES[0])
    samples = slo.dlq_ratio_samples(c.stored, c.dead_letters, grid)
    for more in (slo.oldest_pending_samples(c.ledger_times, grid), lag, fixture.readiness_samples(c.ingest.routed),
                 slo.persistence_p99(slo.bucket_counters(c.stored, grid, restart))):
        samples = samples.unionByName(more)
    rules = [(name, metric, agg, op, fixture.LAG_THRESHOLD if metric == "queue_lag" else threshold, hold)
             for name, metric, agg, op, threshold, hold in ALERT_RULES]
    return slo.evaluate_rules(samples, grid, rules, when_absent=["TelemetryWorkerUnavailable"])


@register("request_latency_histogram")
def request_latency_histogram(c):
    """M2: request latencies in milliseconds, per concurrency."""
    from fleetline.plans import requests as B
    from fleetline.plans import slo
    from pyspark.sql import functions as F
    return slo.request_latency_histogram(B.fixture_request_log(c.table("events")), [F.col("concurrency")]).select(
        "concurrency", "le", "count")


@register("validated_records")
def validated_records(c):
    """The records that the validated stream gets, their payload parsed again."""
    from fleetline.plans import dispatch
    from pyspark.sql import functions as F
    sent = dispatch.validated_records(c.ingest.ledger, c.params.now)
    body = F.col("value").cast("string")
    p = F.from_json(body, "event_id string, device_id string, timestamp string, avg_temperature_5m double, "
                          "voltage_drop_detected boolean, event_lag_ms bigint, outlier_detected boolean").alias("p")
    return sent.select(
        F.col("key").cast("string").alias("record_key"), F.col("headers")[0]["key"].alias("header_name"),
        F.col("headers")[0]["value"].cast("string").alias("header_value"),
        F.array_join(F.json_object_keys(body), ",").alias("payload_keys"), p).select(
        "record_key", "header_name", "header_value", "payload_keys", "p.*")


@register("dead_letter_records")
def dead_letter_records(c):
    """The records that the dead-letter stream gets, their body parsed again."""
    from fleetline.plans import dispatch
    from pyspark.sql import functions as F
    sent = dispatch.dead_letter_records(c.dead_letters, c.params.now)
    body = F.col("value").cast("string")
    return sent.select(
        F.col("key").cast("string").alias("record_key"), F.array_join(F.json_object_keys(body), ",").alias("body_keys"),
        F.get_json_object(body, "$.reason").alias("reason"),
        F.get_json_object(body, "$.source.topic").alias("topic"),
        F.get_json_object(body, "$.source.partition").cast("int").alias("partition"),
        F.get_json_object(body, "$.source.offset").cast("bigint").alias("offset"),
        F.get_json_object(body, "$.payload.event.device_id").alias("device_id"),
        F.get_json_object(body, "$.payload.raw_base64").isNotNull().alias("raw"),
        F.get_json_object(body, "$.failed_at").alias("failed_at"))


# --- B1-B3, C1: request log and quota -----------------------------------------------

def _accepted_ids(c):
    from pyspark.sql import functions as F
    return c.edge_checked.filter(F.size("errors") == 0).select("event_id")


@register("request_latency_summary")
def request_latency_summary(c):
    from fleetline.plans import requests as B
    return B.latency_summary(B.fixture_request_log(c.table("events")))


@register("run_matrix_summary")
def run_matrix_summary(c):
    from fleetline.plans import requests as B
    runs = B.run_rows(B.fixture_request_log(c.table("events")), _accepted_ids(c), c.events)
    return B.matrix_summary(runs, max_pipeline_seconds=6 * 3600.0)


@register("reconcile_sent_stored")
def reconcile_sent_stored(c):
    from fleetline.plans import requests as B
    return B.reconcile(B.fixture_request_log(c.table("events")), _accepted_ids(c), c.events)


@register("quota_audit")
def quota_audit(c):
    from fleetline.plans import requests as B
    return B.quota_audit(B.fixture_request_log(c.table("events")))


@register("lag_gauge")
def lag_gauge(c):
    """M7: consumer lag sum/max per minute from the fixture start to ``now``."""
    from fleetline.plans import slo
    from fleetline.sources.fixture import BASE_US
    from pyspark.sql import functions as F
    grid = slo.minute_grid(F.timestamp_micros(F.lit(BASE_US)), c.params.now, c.ingest.routed)
    return slo.lag_gauge(c.ingest.routed, grid)
