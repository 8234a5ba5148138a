"""Recent lists and latest values as keyed stream state.

Two stateful queries (RocksDB) over the raw log, the second one fed by the
files of the first one's batches, as an aggregation that updates its rows ends
a query:

* by event id (:func:`touched`): the first valid delivery of an id is its
  stored row and stays; a batch emits a touch of that row for every id that it
  delivers.  A streaming aggregation in the JVM: the least row by (batch's
  instant, place in the log), so an earlier batch wins whatever its offsets.
  With ``id_ttl_days`` :class:`FirstWins` holds the rows instead, as an
  aggregation without event time cannot forget a key;
* by device: the list of the newest ``RECENT_LIST_SIZE`` touched rows
  (:class:`RecentList`).  A touch moves its row to the front and renews the
  list's 24 hours; a timer (``transformWithState``) clears the list when they
  are over.

A batch hands over its newest touches, one packed row per device, so the lists'
Python state sees a device once per batch and never a part of its touches.
Both see a batch's rows of a key in log order.  After a batch every device
that was touched (or has expired) emits its list; the sink keeps the newest
one of each device in a bucketed table, published batch by batch, so a
restart or a repeated batch changes nothing.  ``RecentStore.read`` gives the
lists at an instant: position 1 is the latest value (T3).

State grows by one small row per event id, as first-wins over the whole
history needs; ``id_ttl_days`` (the retention days) bounds it.  A device's
state is at most 50 rows.  Expiry runs on the processing clock, like the
cache it stands for; ``read`` applies it to any instant asked.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from threading import TIMEOUT_MAX, Timer

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fleetline.constants import CACHE_TTL_SECONDS, RECENT_LIST_SIZE
from fleetline.operators import route as R
from fleetline.session import checkpoint_dir
from fleetline.streaming.job import raw_stream
from fleetline.tables.bucketed import Bucketed
from fleetline.tables.manifest import Change, Files, Manifest

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 24 * 3600 * 1000
ROW = "event_id string, device_id string, timestamp timestamp, temperature double, voltage double"
PLACE = "source_partition int, source_offset bigint, arrival_ts timestamp"
TOUCH = f"{ROW}, {PLACE}"
ENTRY = "event_id string, timestamp timestamp, temperature double, voltage double, arrival_ts timestamp"
LIST = f"device_id string, position int, {ENTRY}"
PACKED = "device_id string, entries string"         # entries: JSON, the newest first, times in microseconds
TOUCHES = f"batch bigint, {PACKED}"
STORED = [c.split()[0] for c in ROW.split(", ")]
PLACES = [c.split()[0] for c in PLACE.split(", ")]
ENTRIES = [c.split()[0] for c in ENTRY.split(", ")]
TIMES = [c.split()[0] for c in ENTRY.split(", ") if c.endswith(" timestamp")]


def in_log_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=lambda r: tuple(r[c] for c in PLACES))


class FirstWins(StatefulProcessor):
    """Per event id: the stored row; emits it with each delivery's place."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("stored", ROW, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = in_log_order(rows)
        first = self.stored.get() if self.stored.exists() else None
        if first is None:
            first = tuple(arrived[0][c] for c in STORED)
            self.stored.update(first)
        last = arrived[-1]                # a row's earlier touches in a batch leave no trace
        yield Row(*STORED, *PLACES)(*first, *[last[c] for c in PLACES])

    def close(self) -> None:
        pass


class RecentList(StatefulProcessor):
    """Per device: its newest touched rows, the newest first.

    Every call of the state and every value in Python costs far more than the
    work on a list, so a list is one packed value, read and written once per
    batch, and the timer is set once: if the list was renewed meanwhile, the
    timer is set again when it fires."""

    def __init__(self, size: int = RECENT_LIST_SIZE, ttl_ms: int = CACHE_TTL_SECONDS * 1000):
        self.size, self.ttl_ms = size, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.list = handle.getValueState("list", "expires bigint, timer bigint, entries string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.list.get()
        entries = [] if held is None else json.loads(held[2])
        for row in sorted(rows, key=lambda r: r["batch"]):
            touched = json.loads(row["entries"])
            ids = {e["event_id"] for e in touched}
            entries = (touched + [e for e in entries if e["event_id"] not in ids])[:self.size]
        at = timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms
        timer = None if held is None else held[1]
        if timer is None or at < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
            timer = at
        packed = json.dumps(entries, ensure_ascii=False)
        self.list.update((at, timer, packed))
        yield Row("device_id", "entries")(key[0], packed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.list.get()
        if held is None or held[1] != expiredTimerInfo.getExpiryTimeInMs():
            return
        if held[0] <= timerValues.getCurrentProcessingTimeInMs():
            self.list.clear()
            yield Row("device_id", "entries")(key[0], None)
        else:
            self.handle.registerTimer(held[0])
            self.list.update((held[0], held[0], held[2]))

    def close(self) -> None:
        pass


def touched(valid: DataFrame, id_ttl_days: int | None = None) -> DataFrame:
    """Streaming frame (update mode): per id delivered in a batch its stored
    row with the place of its last delivery."""
    rows = valid.select(*STORED, *PLACES)
    if id_ttl_days is not None:
        return rows.groupBy("event_id").transformWithState(
            FirstWins(id_ttl_days * DAY_MS), TOUCH, "Update", "ProcessingTime")
    rest = [c for c in STORED if c != "event_id"]
    seen = rows.withColumn("_seen", F.current_timestamp())                  # the batch's instant
    return seen.groupBy("event_id").agg(
        F.min(F.struct("_seen", *PLACES, *rest)).alias("_first"), F.max(F.struct("_seen", *PLACES)).alias("_last")) \
        .select("event_id", *[F.col(f"_first.{c}").alias(c) for c in rest],
                *[F.col(f"_last.{c}").alias(c) for c in PLACES]).select(*STORED, *PLACES)


def newest_touches(touches: DataFrame, size: int = RECENT_LIST_SIZE) -> DataFrame:
    """(device_id, entries): the ``size`` last touched rows of every device in a
    batch's touches.  The others can be in no list after the batch: the
    list's rows were all touched after them.  Each task limits its own rows
    before they are dealt by device, so a hot device is not sorted in one task."""
    newest = Window.partitionBy("device_id").orderBy(*[F.col(c).desc() for c in (*PLACES, "event_id")])
    ranked = touches.withColumn("position", F.row_number().over(newest)).filter(F.col("position") <= size)
    entry = F.struct("position", *[F.unix_micros(c).alias(c) if c in TIMES else F.col(c) for c in ENTRIES])
    lists = ranked.groupBy("device_id").agg(F.array_sort(F.collect_list(entry)).alias("_list"))      # at most ``size`` rows
    return lists.select("device_id", F.to_json(
        F.transform("_list", lambda e: F.struct(*[e[c].alias(c) for c in ENTRIES]))).alias("entries"))


def unpacked(entries: Column) -> Column:
    """A packed list as an array of (position, entry columns); position 0 marks
    an expired one."""
    kinds = dict(zip(ENTRIES, [c.split()[1] for c in ENTRY.split(", ")]))
    packed = ", ".join(f"{c} {'bigint' if c in TIMES else kind}" for c, kind in kinds.items())
    value = lambda e, c: F.timestamp_micros(e[c]) if c in TIMES else e[c]
    lists = F.transform(F.from_json(entries, f"array<struct<{packed}>>"), lambda e, i: F.struct(
        (i + 1).alias("position"), *[value(e, c).alias(c) for c in ENTRIES]))
    expired = F.struct(F.lit(0).alias("position"), *[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()])
    return F.when(entries.isNull(), F.array(expired)).otherwise(lists)


def recent_lists(touches: DataFrame, size: int = RECENT_LIST_SIZE, ttl_ms: int = CACHE_TTL_SECONDS * 1000) -> DataFrame:
    """Streaming frame of changed lists, packed; an expired one is null."""
    return touches.groupBy("device_id").transformWithState(RecentList(size, ttl_ms), PACKED, "Append", "ProcessingTime")


def newest_list(rows: DataFrame) -> DataFrame:
    return rows.groupBy("device_id").agg(F.max("_list").alias("_list"))


@dataclass(frozen=True)
class RecentStore:
    """The lists that the stream has published."""
    root: str
    buckets: int = 16

    def _table(self, spark: SparkSession) -> Bucketed:
        return Bucketed(Manifest(spark, self.root), "recent", "device_id", newest_list, self.buckets)

    def add(self, changed: DataFrame, batch_id: int) -> None:
        """Publish the lists that a batch changed; once per batch."""
        table = self._table(changed.sparkSession)
        base = table.manifest.version()
        if base.has(0, batch_id):
            return
        change = Change(table.manifest, base)
        lists = changed.select("device_id", F.struct(
            F.lit(batch_id).alias("batch"), unpacked(F.col("entries")).alias("entries")).alias("_list"))
        table.append(change, lists, 0, batch_id, keep_empty=False)        # most batches run for the timers alone
        change.next.batches["0"] = batch_id
        change.publish(batch_id=batch_id)

    def read(self, spark: SparkSession, now: Column | None = None, devices: DataFrame | None = None) -> DataFrame:
        """(device_id, position, entry columns): the lists, without those whose
        newest touch is over 24 hours before ``now``.  ``devices``: only
        theirs, from their buckets."""
        table = self._table(spark)
        version = table.manifest.version()
        rows = table.read(version, None if devices is None else table.used(devices, version))
        if rows is None:
            return spark.createDataFrame([], LIST)
        if devices is not None:
            rows = rows.join(devices.select("device_id").distinct(), "device_id", "left_semi")
        lists = newest_list(rows)
        if now is not None:
            newest = F.element_at("_list.entries", 1)["arrival_ts"]
            lists = lists.filter(newest > now - F.expr(f"INTERVAL {CACHE_TTL_SECONDS} SECONDS"))
        return lists.select("device_id", F.explode("_list.entries").alias("_e")).select("device_id", "_e.*") \
            .filter("position > 0")


def note_touches(folder: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch's newest touches to a folder of its own, a row per device;
    once per batch.  A write that broke off is done again: the same touches
    twice change no list."""
    def write(batch: DataFrame, batch_id: int) -> None:
        files = Files(batch.sparkSession, folder)
        if not files.exists(f"{batch_id:012d}/_SUCCESS"):
            newest_touches(batch).select(F.lit(batch_id).cast("bigint").alias("batch"), "device_id", "entries") \
                .write.mode("overwrite").parquet(f"{folder}/{batch_id:012d}")
    return write


class RecentQuery:
    """The two streaming queries as one: first ids, then lists."""

    def __init__(self, ids, lists, timed: bool = False):
        self.ids, self.lists, self.timed = ids, lists, timed          # timed: ids ask for a batch at every trigger

    @property
    def isActive(self) -> bool:
        return self.ids.isActive and self.lists.isActive

    def stop(self) -> None:
        self.ids.stop()
        self.lists.stop()

    def exception(self):
        return self.ids.exception() or self.lists.exception()


def start(spark: SparkSession, source: str, store: RecentStore, checkpoint: str, *, kafka_servers: str | None = None,
          max_per_trigger: int | None = None, processing_time: Callable[[DataFrame], Column] | None = None,
          interval: str = "1 second", ttl_ms: int = CACHE_TTL_SECONDS * 1000,
          id_ttl_days: int | None = None, lists_interval: str | None = None) -> RecentQuery:
    """Start the stream of recent lists (``lists_interval``: their own trigger).

    It runs until stopped: state with processing-time timers asks for a batch
    at every trigger, so an ``availableNow`` run of it would never end
    (:func:`run_until_idle` takes its place)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    folder = f"{store.root.rstrip('/')}/_touches"
    files = Files(spark, folder)
    files.fs.mkdirs(files._path(""))
    stream = raw_stream(spark, source, kafka_servers=kafka_servers, max_per_trigger=max_per_trigger)
    valid = R.valid_deliveries(R.decided(R.route(stream, processing_time)))
    ids = (touched(valid, id_ttl_days).writeStream
           .option("checkpointLocation", f"{checkpoint}/ids").outputMode("update")
           .foreachBatch(note_touches(folder)).trigger(processingTime=interval).start())
    touches = spark.readStream.schema(TOUCHES).option("recursiveFileLookup", "true") \
        .option("ignoreMissingFiles", "true").option("cleanSource", "delete").parquet(folder)
    lists = (recent_lists(touches, ttl_ms=ttl_ms).writeStream
             .option("checkpointLocation", f"{checkpoint}/lists").outputMode("append")
             .foreachBatch(store.add).trigger(processingTime=lists_interval or interval).start())
    return RecentQuery(ids, lists, id_ttl_days is not None)


def _progress(query) -> tuple[int, int, int]:
    """(progress reports, last batch, its rows) of a streaming query."""
    done = query.recentProgress
    return (len(done), done[-1].batchId, done[-1].numInputRows) if done else (0, -1, -1)


def run_until_idle(query: RecentQuery, seconds: float = 600.0) -> None:
    """Let a stream work through what its source has, then stop it; at most
    ``seconds`` (``math.inf``: as long as it takes).  The ids
    are through when no data is available to them; the lists when a batch
    that began after that has no input.  The first batch after a start does
    not count, as it may repeat one that was not committed."""
    end, through = time.monotonic() + seconds, None
    watch = Timer(min(seconds, TIMEOUT_MAX), query.ids.stop)    # processAllAvailable has no time limit
    watch.start()
    try:
        while query.timed and query.isActive and time.monotonic() < end:
            reports, _, rows = _progress(query.ids)
            if reports > 1 and rows == 0:
                break
            time.sleep(0.2)
        if not query.timed:
            query.ids.processAllAvailable()
        while query.isActive and time.monotonic() < end:
            reports, last, rows = _progress(query.lists)
            through = last if through is None else through
            if reports > 1 and last > through + 1 and rows == 0:
                return
            time.sleep(0.2)
        if query.exception() is None:
            raise TimeoutError(f"the stream was still at work after {seconds} s")
    finally:
        watch.cancel()
        query.stop()
    raise query.exception()


def replayed(spark: SparkSession, log: DataFrame, start_at: Column, slices, interval: str, files: int | None = None,
             partitions: int | None = None) -> DataFrame:
    """The lists after a log was streamed slice by slice (``slices`` of its
    append time, in ``interval`` units after ``start_at``), a micro-batch each.

    Everything lies under the shared checkpoint folder.  The number of state
    partitions is fixed when a stream begins, so it is set for that moment, by
    default to the cluster's cores; so are the files of a slice, as a batch is
    decoded in a task per file."""
    cores = spark.sparkContext.defaultParallelism
    files, partitions = files or cores, partitions or cores
    root = f"{checkpoint_dir(spark).rstrip('/')}/recent-{uuid.uuid4().hex}"
    written = Files(spark, root)
    for i, (low, high) in enumerate(slices, 1):
        part = log
        if low is not None:
            part = part.filter(F.col("timestamp") >= start_at + F.expr(interval.format(low)))
        if high is not None:
            part = part.filter(F.col("timestamp") < start_at + F.expr(interval.format(high)))
        part.repartition(files, "partition", "offset").write.mode("append").parquet(f"{root}/log")   # later files, later batches
        there = sum(name.endswith(".parquet") for name in written.names("log"))
        for _ in range(i * files - there):                # a small slice fills fewer files: none of the next one's in its batch
            part.limit(0).write.mode("append").parquet(f"{root}/log")
    store, key = RecentStore(f"{root}/tables"), "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        run_until_idle(start(spark, f"{root}/log", store, f"{root}/checkpoint", max_per_trigger=files,
                             interval="0 seconds", lists_interval="3 seconds"), math.inf)
    finally:
        spark.conf.set(key, before)
    return store.read(spark)
