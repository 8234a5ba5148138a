"""Writers with acknowledgements: validated records, dead letters, replays
(S6, S7, T6, L6).

Each job claims rows that have no acknowledgement yet, appends their records
to a log, and publishes acknowledgements for what the log's commit lists.  A
crash between the two sends the same records again, under the same ids; a
record is never marked that the log does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetline.constants import DEAD_LETTER_TOPIC, RAW_TOPIC, VALIDATED_TOPIC
from fleetline.operators.state import iso_utc
from fleetline.plans import deadletter as L
from fleetline.sources import record_log
from fleetline.streaming.job import TableStore, delete
from fleetline.tables.manifest import Change

def coordinates() -> Column:
    return F.concat_ws(":", *L.COORDS)



def header(name: str, value: Column) -> Column:
    return F.array(F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value")))


def validated_records(ledger: DataFrame, at: Column) -> DataFrame:
    """key = device, value = the seven-field payload, header = event id."""
    return ledger.select(
        F.col("message_key").cast("binary").alias("key"), F.col("payload").cast("binary").alias("value"),
        header("event_id", F.col("event_id")).alias("headers"), at.alias("timestamp"),
        F.col("event_id").alias("ack_id"))


def dead_letter_records(dead: DataFrame, at: Column) -> DataFrame:
    """key = coordinates, value = payload, reason, source and time."""
    body = F.to_json(F.struct(
        F.parse_json("payload").alias("payload"), "reason",
        F.struct(F.col("source_topic").alias("topic"), F.col("source_partition").alias("partition"),
                 F.col("source_offset").alias("offset")).alias("source"),
        iso_utc(at).alias("failed_at")))
    return dead.select(coordinates().cast("binary").alias("key"), body.cast("binary").alias("value"),
                       F.array().cast("array<struct<key: string, value: binary>>").alias("headers"),
                       at.alias("timestamp"), coordinates().alias("ack_id"))


def replay_records(dead: DataFrame, requested: DataFrame, at: Column, corrections: DataFrame | None) -> DataFrame:
    """The restored (or corrected) bytes under the device's key."""
    sent = L.replay_deliveries(dead, requested, RAW_TOPIC, at, corrections)
    return sent.select("key", "value", "headers", "timestamp",
                       F.element_at("headers", 1)["value"].cast("string").alias("ack_id"))


def send(spark: SparkSession, store: TableStore, name: str, claimed: DataFrame, records, id_of: Column,
         log: str, topic: str, at: Column, ack: str) -> int:
    """Append the records of ``claimed`` (written first: a claim must not
    change between sending and marking) and publish their acknowledgements;
    how many."""
    work = store.path(f"_work/{name}")
    claimed.write.mode("overwrite").parquet(work)
    kept = spark.read.schema(claimed.schema).parquet(work)
    commit = record_log.append(spark, records(kept), log, topic)
    acked = kept.withColumn("ack_id", id_of).join(record_log.acknowledged(spark, log, commit), "ack_id", "left_semi")
    kept_columns = [c for c in claimed.columns if c not in ("payload", "reason", "message_key")]
    count = publish_acks(spark, store, name, acked.select(*kept_columns).withColumn(ack, at))
    delete(spark, work)
    return count


def publish_acks(spark: SparkSession, store: TableStore, name: str, acks: DataFrame) -> int:
    """Add acknowledgement rows to the store's next version."""
    manifest = store.manifest(spark)
    change = Change(manifest, manifest.version())
    entry = store.write_batch(acks, name, -1 - change.base.number, 0)
    if entry["rows"]:
        change.know(name, acks)
        change.add(name, entry)
        change.publish(acknowledged=name, rows=entry["rows"])
    return entry["rows"]


def _left(rows: DataFrame, acks: DataFrame | None, keys: list[str]) -> DataFrame:
    return rows if acks is None else rows.join(acks.select(*keys), keys, "left_anti")


def dispatch_validated(spark: SparkSession, store: TableStore, log: str, at: Column, limit: int = 100) -> int:
    """T5 + S6 + T6: send the oldest ``limit`` pending ledger rows."""
    ledger = store.read(spark, "ledger")
    if ledger is None:
        return 0
    claimed = _left(ledger, store.read(spark, "acks"), ["event_id"]).orderBy("created_at", "event_id").limit(limit)
    claimed = claimed.select("event_id", "message_key", "payload", "event_date")
    return send(spark, store, "acks", claimed, lambda rows: validated_records(rows, at), F.col("event_id"),
                log, VALIDATED_TOPIC, at, "published_at")


def dispatch_dead_letters(spark: SparkSession, store: TableStore, log: str, at: Column) -> int:
    """Send every dead letter that was not sent yet, once."""
    dead = store.dead_letters(spark)
    if dead is None:
        return 0
    claimed = _left(dead, store.read(spark, "dead_letter_acks"), L.COORDS).select(*L.COORDS, "payload", "reason")
    return send(spark, store, "dead_letter_acks", claimed, lambda rows: dead_letter_records(rows, at), coordinates(),
                log, DEAD_LETTER_TOPIC, at, "published_at")


def replay_job(spark: SparkSession, store: TableStore, requested: DataFrame, log: str, at: Column,
               corrections: DataFrame | None = None, execute: bool = False) -> DataFrame:
    """L5 + L6: the plan of the requested coordinates, and, executing, their
    records appended to the raw log and an audit row for each the log has.
    A dry run sends and marks nothing.  Returns the plan as it was before."""
    dead = store.dead_letters(spark)
    if dead is None:
        raise ValueError("the store has no dead letters")
    replays = store.read(spark, "replays")
    audit = dead.select(*L.COORDS).limit(0).withColumn("replayed_at", at) if replays is None else replays
    plan = L.replay_plan(dead, audit, requested, corrections).withColumn("executed", F.lit(execute))
    if not execute:
        return plan
    plan = spark.createDataFrame(plan.collect(), plan.schema)          # as long as the request
    missing = plan.filter(~F.col("found")).count()
    if missing:
        raise ValueError(f"{missing} of the requested dead letters were not found")
    claimed = dead.join(requested.select(*L.COORDS).distinct(), L.COORDS, "left_semi")
    send(spark, store, "replays", claimed.select(*L.COORDS, "payload", "reason"),
         lambda rows: replay_records(rows, rows.select(*L.COORDS), at, corrections), coordinates(),
         log, RAW_TOPIC, at, "replayed_at")
    return plan
