"""The streaming ingest job.

``readStream`` over the raw log (Kafka when its connector is on the class
path, else a folder of delivery files) -> ``foreachBatch`` -> the same
operators as the batch job.  Per micro-batch:

1. pin the newest version of the store; a batch that it lists is done already
   (its checkpoint commit was lost), so nothing happens;
2. route the batch (kept: both branches are written);
3. insert-if-absent: first arrivals of the batch whose ids the id index does
   not hold; only index files that may hold one are opened;
4. enrich the new events against what they can see of the history: the stored
   rows of their devices in their dates' 5-minute band and their devices'
   newest reading, a table of one row per device (exact, see
   :func:`enrich_batch`);
5. write dead letters, ledger rows, ids, device states, events and the batch's
   share of the counters to new folders, check the counts, and publish them
   together as the next version.

So no step reads the whole history, a batch that fails before the last step
leaves every table as it was, and a repeated one begins again from there.
:mod:`fleetline.tables.manifest` says what a version is.  The run number
belongs to the checkpoint folder (:func:`stream_run`).

Device states and dead letters are folded when read (:meth:`TableStore.status`,
:meth:`TableStore.dead_letters`).  One run writes to a store at a time.

No watermark and no event-time window state: late events of any age are
accepted, as history is the stored table itself.  The checkpoint folder
commits source offsets after ``foreachBatch`` returns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetline.operators import enrich as E
from fleetline.operators import route as R
from fleetline.operators import state as S
from fleetline.plans.deadletter import reason_class
from fleetline.plans.pipeline import Materialize, dead_letter_rows, lazy
from fleetline.tables.bucketed import Bucketed
from fleetline.tables.ids import IdIndex
from fleetline.tables.manifest import Change, Files, Manifest, Version

DELIVERY_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
])


STORED_COLUMNS = ["event_id", "device_id", "timestamp", "received_at", "processed_at", "temperature",
                  "voltage", "status", "region", "source_topic", "source_partition", "source_offset",
                  "arrival_ts"]


READING_ORDER = ["timestamp", *E.ARRIVAL_ORDER]
READING = [*READING_ORDER, *[c for c in STORED_COLUMNS if c not in (*READING_ORDER, "device_id")]]
RUNS_SCHEMA = "run bigint, source string, state string"


def newest_readings(rows: DataFrame) -> DataFrame:
    """(device_id, _reading): each device's newest stored row, by event time
    and then arrival; of ``rows`` with stored columns or already folded."""
    if "_reading" not in rows.columns:
        rows = rows.select("device_id", F.struct(*READING).alias("_reading"))
    return rows.groupBy("device_id").agg(F.max("_reading").alias("_reading"))


def newest_states(rows: DataFrame) -> DataFrame:
    return rows.groupBy("device_id").agg(F.max("_winner").alias("_winner"))


@dataclass(frozen=True)
class TableStore:
    """The stored tables (Parquet folders and versions) under one shared root.

    ``id_buckets`` and ``device_buckets`` count for a store's first write."""
    root: str
    id_buckets: int = 16
    device_buckets: int = 16

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def manifest(self, spark: SparkSession) -> Manifest:
        return Manifest(spark, self.root)

    def ids(self, manifest: Manifest) -> IdIndex:
        return IdIndex(manifest, self.id_buckets)

    def readings(self, manifest: Manifest) -> Bucketed:
        """Each device's newest reading, from the events that are stored."""
        return Bucketed(manifest, "device_newest", "device_id", newest_readings, self.device_buckets)

    def states(self, manifest: Manifest) -> Bucketed:
        """Each device's last written state (retention does not touch it)."""
        return Bucketed(manifest, "device_status", "device_id", newest_states, self.device_buckets)

    def read(self, spark: SparkSession, name: str, version: int | None = None) -> DataFrame | None:
        """A table in the newest (or a given) version; None if never written."""
        if name == "runs":
            there = Files(spark, self.root).exists(name)
            return spark.read.schema(RUNS_SCHEMA).parquet(self.path(name)) if there else None
        manifest = self.manifest(spark)
        return manifest.read(manifest.version(version), name)

    def write_batch(self, df: DataFrame, name: str, run: int, batch_id: int) -> dict:
        """Write the rows of a batch to a new folder; its entry, to be
        published.  Dated tables lie by date, events also by device and time
        inside a file; a hot device's day is dealt by hour."""
        by = ["event_date"] if "event_date" in df.columns else []
        if name == "events":
            df = df.repartition("event_date", "device_id", F.date_trunc("hour", "timestamp")) \
                .sortWithinPartitions(*by, "device_id", "timestamp")
        return self.manifest(df.sparkSession).write(df, name, run, batch_id, by)

    def band(self, manifest: Manifest, version: Version, new: DataFrame) -> DataFrame | None:
        """Stored rows of the devices of ``new`` within 5 minutes before any of
        their new rows.  Only the folders of the dates concerned are opened."""
        stored = manifest.read(version, "events")
        if stored is None:
            return None
        at = F.unix_micros("timestamp")
        dates = new.select(F.explode(F.array(F.to_date("timestamp"), F.to_date(F.timestamp_micros(at - E.WINDOW_US))))
                           .alias("event_date")).distinct()
        span = new.groupBy("device_id").agg((F.min(at) - E.WINDOW_US).alias("_from_us"), F.max(at).alias("_to_us"))
        # The dates of a batch: a short list, so that folders are pruned.
        of_dates = stored.filter(F.col("event_date").isin([r["event_date"] for r in dates.collect()]))
        return of_dates.join(span, "device_id").filter((at >= F.col("_from_us")) & (at <= F.col("_to_us"))) \
            .select(*new.columns)

    def newest(self, manifest: Manifest, version: Version, new: DataFrame) -> DataFrame | None:
        """The newest stored reading of every device of ``new``; only the
        buckets of these devices are opened."""
        table = self.readings(manifest)
        rows = table.read(version, table.used(new, version))
        if rows is None:
            return None
        mine = rows.join(new.select("device_id").distinct(), "device_id", "left_semi")
        return newest_readings(mine.select("device_id", "_reading")).select(
            "device_id", "_reading.*").select(*new.columns)

    def status(self, spark: SparkSession, rows: DataFrame | None = None) -> DataFrame | None:
        """The current device state: every batch writes the devices it saw."""
        rows = self.read(spark, "device_status") if rows is None else rows
        return None if rows is None else newest_states(rows).select(
            "device_id", "_winner.region", "_winner.last_seen", "_winner.status", "_winner.temperature",
            "_winner.voltage")

    def counters(self, spark: SparkSession) -> DataFrame | None:
        """The pipeline's counters: all batches' samples added up."""
        rows = self.read(spark, "metric_samples")
        return None if rows is None else rows.groupBy(
            "metric", F.element_at("labels", "reason").alias("reason")).agg(F.sum("value").alias("value"))

    def dead_letters(self, spark: SparkSession) -> DataFrame | None:
        """One row per coordinate over all batches: first payload and
        creation time, latest reason."""
        rows, when = self.read(spark, "dead_letters"), F.struct("created_at", "run", "batch_id")
        return None if rows is None else rows.groupBy("source_topic", "source_partition", "source_offset").agg(
            F.min_by("payload", when).alias("payload"), F.max_by("reason", when).alias("reason"),
            F.min("created_at").alias("created_at"), F.min("arrival_ts").alias("arrival_ts"))


def next_run(spark: SparkSession, store: TableStore) -> int:
    """A run number above all in the store."""
    started = store.read(spark, "runs")
    return 0 if started is None else started.agg(F.coalesce(F.max("run"), F.lit(-1))).first()[0] + 1


def note_run(spark: SparkSession, store: TableStore, source: str, state: str, run: int) -> None:
    spark.createDataFrame([(run, source, state)], RUNS_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(store.path("runs"))


def stream_run(spark: SparkSession, store: TableStore, source: str, checkpoint: str) -> int:
    """The run number of a checkpoint folder, kept in it.  A fresh checkpoint
    over a filled store is a new run: batch ids start again, tables stay."""
    kept = Files(spark, checkpoint)
    if kept.exists("ingest_run"):
        return int(kept.text("ingest_run"))
    run = next_run(spark, store)
    note_run(spark, store, source, "stream", run)
    kept.put_new("ingest_run", str(run))
    return run


def raw_stream(spark: SparkSession, source: str, *, kafka_servers: str | None = None,
               topic: str = "raw-telemetry", max_per_trigger: int | None = None) -> DataFrame:
    """The raw log as a streaming frame with the Kafka source columns.

    Kafka: from the earliest offsets, ``maxOffsetsPerTrigger`` bounded
    micro-batches.  Files: a folder of delivery files (same columns), one
    file per trigger at most when ``max_per_trigger`` is set.
    """
    if kafka_servers:
        reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
                  .option("subscribe", topic).option("startingOffsets", "earliest"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return reader.load().select("key", "value", "topic", "partition", "offset", "timestamp")
    reader = spark.readStream.schema(DELIVERY_SCHEMA)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return reader.parquet(source)


def enrich_batch(new: DataFrame, near: DataFrame | None, newest: DataFrame | None,
                 materialize: Materialize = lazy) -> DataFrame:
    """Enrich the first arrivals of a batch against the stored history.

    Only two kinds of stored rows can influence a new row: rows of the same
    device within 5 minutes before its timestamp (``near``, the trailing mean)
    and the device's newest stored reading (``newest``, the drop check).  Those
    are unioned with the batch, enriched together, and only the batch rows are
    kept.  Every history row comes before every batch row, whatever its offset,
    so the result equals the one-shot enrichment.  ``materialize`` is called
    once, on the union, which is read three times; ``new`` should be a written
    table.
    """
    past = [rows for rows in (near, newest) if rows is not None]
    if not past:
        return E.enrich(new)
    context = reduce(DataFrame.unionByName, past).dropDuplicates(["event_id"])
    both = materialize(context.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1))), "context")
    enriched = E.enrich(both, ["_new", *E.ARRIVAL_ORDER])
    return enriched.join(both.filter("_new = 1").select("event_id"), "event_id", "left_semi")


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


SAMPLES_SCHEMA = "metric string, labels map<string, string>, value double"


def batch_samples(routed: DataFrame, new_events: int) -> DataFrame:
    """M1 live: what one batch adds to the pipeline's counters, a row per
    metric and label set.  ``routed`` is a written table."""
    spark = routed.sparkSession
    rows = routed.groupBy(reason_class(F.col("reason")).alias("reason")).count().collect()    # reason families
    counts = {r["reason"]: r["count"] for r in rows}
    valid = counts.pop(None, 0)
    out = [("events_ingested_total", {}, float(valid + sum(counts.values()))),
           ("events_processed_total", {}, float(new_events)), ("duplicate_events_total", {}, float(valid - new_events))]
    out += [("dead_letter_count", {"reason": reason}, float(n)) for reason, n in sorted(counts.items())]
    return spark.createDataFrame(out, SAMPLES_SCHEMA).withColumn("ts", F.current_timestamp())


def process_batch(batch: DataFrame, batch_id: int, store: TableStore,
                  processing_time: Callable[[DataFrame], Column] | None = None, run: int = 0) -> None:
    """Ingest one batch into the store; the batch job and ``foreachBatch`` both
    call it.  All its rows appear in one published version or not at all, and a
    batch that is published already is left alone.  Frames that are read more
    than once are written under the store's ``_work`` folder, which keeps plans
    short and survives lost executors, and deleted when the batch is done.
    """
    spark = batch.sparkSession
    manifest = store.manifest(spark)
    base = manifest.version()
    if base.has(run, batch_id):
        return
    work = store.path(f"_work/{run}-{batch_id}")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    change, index = Change(manifest, base), store.ids(manifest)
    routed = written(R.route(batch, processing_time), "routed")
    first = written(E.first_arrivals(R.valid_deliveries(routed)).select(*STORED_COLUMNS), "first")
    probe = index.unseen(base, first)
    new = written(probe.unseen.select(*STORED_COLUMNS), "new")
    enriched = enrich_batch(new, store.band(manifest, base, new), store.newest(manifest, base, new), written)
    events = written(enriched.withColumn("event_date", F.to_date("timestamp")), "enriched")

    def add(df: DataFrame, name: str) -> dict:
        entry = store.write_batch(df, name, run, batch_id)
        change.know(name, df)
        change.add(name, entry)
        return entry

    add(dead_letter_rows(R.failed_deliveries(routed)), "dead_letters")
    ledger = add(S.ledger_rows(events, "event_date"), "ledger")
    index.append(change, new, run, batch_id)
    store.readings(manifest).append(change, newest_readings(new), run, batch_id)
    store.states(manifest).append(change, S.device_status(events).select("device_id", "_winner"), run, batch_id)
    stored, wanted = add(events, "events"), new.count()
    if not stored["rows"] == ledger["rows"] == wanted:
        raise RuntimeError(f"{wanted} new events, but {stored['rows']} stored and {ledger['rows']} in the ledger")
    add(batch_samples(routed, wanted).coalesce(1), "metric_samples")
    change.next.batches[str(run)] = batch_id
    change.publish(run=run, batch_id=batch_id, new_events=wanted, index_files=probe.files, index_opened=probe.opened)
    delete(spark, work)


def start(spark: SparkSession, source: str, store: TableStore, checkpoint: str, *,
          kafka_servers: str | None = None, max_per_trigger: int | None = None,
          processing_time: Callable[[DataFrame], Column] | None = None, available_now: bool = True):
    """Start the ingest stream; returns the ``StreamingQuery``."""
    run = stream_run(spark, store, source, checkpoint)
    stream = raw_stream(spark, source, kafka_servers=kafka_servers, max_per_trigger=max_per_trigger)
    writer = (stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, bid: process_batch(df, bid, store, processing_time, run)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="250 milliseconds")
    return writer.start()
