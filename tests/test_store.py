"""Versions, id index, device tables, retention and writers over one store."""

import json
import tempfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from fleetline.plans import dispatch, retention
from fleetline.sources import record_log
from fleetline.streaming import job
from fleetline.streaming.job import TableStore, process_batch
from fleetline.tables.bucketed import TIER, Bucketed
from fleetline.tables.ids import IdIndex
from fleetline.tables.manifest import Change, ConcurrentWriter, Manifest
from tests.helpers import T0, deliveries, envelope, event, fixed_processing

DAY = int(T0.timestamp() * 1_000_000)
LATER = datetime(2024, 3, 1, tzinfo=timezone.utc)


def fresh(buckets=2):
    return TableStore(tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t", buckets, buckets)


def ingest(spark, store, batch, bodies, run=0):
    log = deliveries(spark, bodies, start_offset=100 * batch, start_us=DAY + batch * 60_000_000)
    process_batch(log, batch, store, fixed_processing(), run)


def ids_of(spark, store, name="events"):
    return sorted(r["event_id"] for r in store.read(spark, name).collect())


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"))


def test_index_opens_few_files_and_equals_the_full_anti_join(spark):
    manifest = fresh().manifest(spark)
    index, version = IdIndex(manifest, 8), manifest.version()
    for i in range(5):
        change = Change(manifest, version)
        index.append(change, numbers(spark, 400, 400 * i), 0, i)
        version = change.publish()
    asked = numbers(spark, 200, 10_000).union(numbers(spark, 1, 1700)).union(numbers(spark, 1, 90)) \
        .withColumn("more", F.lit(1))
    probe = index.unseen(version, asked)
    full = asked.join(index.ids.read(version), "event_id", "left_anti")
    assert sorted(map(tuple, probe.unseen.collect())) == sorted(map(tuple, full.select(*probe.unseen.columns).collect()))
    assert probe.unseen.count() == 200 and probe.files == 5 * 8 and 2 <= probe.opened <= 8
    assert index.unseen(version, numbers(spark, 0)).opened == 0
    again = index.unseen(version, numbers(spark, 2000))                 # a bloom filter never denies
    assert again.unseen.count() == 0 and again.opened == 40


def test_tiers_bound_the_folders_and_change_no_row(spark):
    manifest = fresh().manifest(spark)
    table = Bucketed(manifest, "newest", "device_id", job.newest_states, 4)
    version, want = manifest.version(), {}
    for i in range(TIER + 3):
        rows = [(f"d{j}", (i * 7 + j * 5) % 11) for j in range(i % 3, 12, 3)]
        for device, value in rows:
            want[device] = max(want.get(device, -1), value)
        change = Change(manifest, version)
        frame = spark.createDataFrame(rows, "device_id string, at int").select(
            "device_id", F.struct("at").alias("_winner"))
        table.append(change, frame, 0, i)
        version = change.publish()
    assert len(version.entries("newest")) == 1 + 3
    got = job.newest_states(table.read(version)).collect()
    assert {r["device_id"]: r["_winner"]["at"] for r in got} == want
    one = spark.createDataFrame([("d4",)], "device_id string")
    buckets = table.used(one, version)
    read = table.read(version, buckets)
    assert len(buckets) == 1 and {r["bucket"] for r in read.select("bucket").distinct().collect()} == set(buckets)
    assert job.newest_states(read).filter("device_id = 'd4'").first()["_winner"]["at"] == want["d4"]


def test_failure_before_publishing_changes_nothing(spark, monkeypatch):
    store = fresh()
    ingest(spark, store, 0, [envelope(event("a")), b"{bad"])
    version = store.manifest(spark).version()
    tables = ("events", "ledger", "dead_letters", "device_status", "device_newest", "event_ids")
    before = {t: store.read(spark, t).count() for t in tables}
    monkeypatch.setattr(Manifest, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest(spark, store, 1, [envelope(event("b", ts="2024-01-02T00:00:00Z")), envelope(event("a")), b"{worse"])
    monkeypatch.undo()
    assert store.manifest(spark).version().number == version.number
    assert {t: store.read(spark, t).count() for t in tables} == before
    # another run stores one of its ids meanwhile; the retry writes one date less and nothing twice
    ingest(spark, store, 0, [envelope(event("b", ts="2024-01-02T00:00:00Z"))], run=1)
    ingest(spark, store, 1, [envelope(event("b", ts="2024-01-02T00:00:00Z")), envelope(event("c")), b"{worse"])
    assert ids_of(spark, store) == ["a", "b", "c"] == ids_of(spark, store, "ledger") == ids_of(spark, store, "event_ids")
    note = store.manifest(spark).version().note
    assert note["new_events"] == 1 and note["index_opened"] <= note["index_files"]
    ingest(spark, store, 1, [envelope(event("zz"))])                    # published already: left alone
    assert ids_of(spark, store) == ["a", "b", "c"]
    assert store.read(spark, "events", version.number).count() == 1     # readers may pin a version
    gone = store.manifest(spark).vacuum(keep=1)
    assert gone and ids_of(spark, store) == ["a", "b", "c"]
    with pytest.raises(ConcurrentWriter):
        Change(store.manifest(spark), version).publish()


def test_live_counters_equal_the_tables(spark):
    store = fresh()
    for batch, bodies in enumerate(([envelope(event("a")), envelope(event("a")), b"{bad"],
                                    [envelope(event("b")), envelope(event("a")), envelope(event("c"), version=9)])):
        ingest(spark, store, batch, bodies)
        ingest(spark, store, batch, bodies)                             # a repeated batch adds nothing
    got = {(r["metric"], r["reason"]): r["value"] for r in store.counters(spark).collect()}
    events, dead = store.read(spark, "events").count(), store.dead_letters(spark).count()
    assert got == {("events_ingested_total", None): 6.0, ("events_processed_total", None): float(events),
                   ("duplicate_events_total", None): 2.0, ("dead_letter_count", "invalid JSON"): 1.0,
                   ("dead_letter_count", "unsupported schema_version"): 1.0}
    assert events == 2 and dead == 2


def test_damaged_store_is_an_error(spark):
    store = fresh()
    assert store.read(spark, "events") is None and store.read(spark, "runs") is None
    ingest(spark, store, 0, [envelope(event("a"))])
    manifest = store.manifest(spark)
    manifest.files.delete(manifest.version().entries("events")[0]["path"])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read(spark, "events").count()


def test_retention_publishes_one_version_and_forgets_ids(spark, monkeypatch):
    store, now = fresh(), F.lit(datetime(2024, 2, 10, tzinfo=timezone.utc))
    ingest(spark, store, 0, [
        envelope(event("old1", device="d1", ts="2024-01-01T00:10:00Z", voltage=12.0, temperature=70.0)),
        envelope(event("old2", device="d1", ts="2024-01-01T00:20:00Z", voltage=12.0, temperature=80.0)),
        envelope(event("kept", device="d2", ts="2024-01-01T00:30:00Z")),
        envelope(event("new1", device="d3", ts="2024-02-09T00:00:00Z"))])
    log = store.path("log")
    assert dispatch.dispatch_validated(spark, store, log, F.lit(LATER), limit=2) == 2
    dry = retention.run_job(spark, store, now, 30)
    assert (dry["mode"], dry["eligible_events"], dry["protected_pending_events"]) == ("dry-run", 2, 1)
    assert len(ids_of(spark, store)) == 4
    for days, size in ((0, None), (1, 0)):
        with pytest.raises(ValueError):
            retention.run_job(spark, store, now, days, size, execute=True)
    monkeypatch.setattr(retention, "assert_report", lambda _: (_ for _ in ()).throw(RuntimeError("counts")))
    with pytest.raises(RuntimeError):
        retention.run_job(spark, store, now, 30, execute=True)
    monkeypatch.undo()
    assert len(ids_of(spark, store)) == 4 and store.read(spark, "rollups") is None
    first = retention.run_job(spark, store, now, 30, 1, execute=True)   # bounded: one event a pass
    second = retention.run_job(spark, store, now, 30, 1, execute=True)
    assert [r["deleted_events"] for r in (first, second)] == [1, 1]
    assert retention.run_job(spark, store, now, 30, 1, execute=True)["eligible_events"] == 0
    left = ["kept", "new1"]
    assert ids_of(spark, store) == left == ids_of(spark, store, "ledger") == ids_of(spark, store, "event_ids")
    assert ids_of(spark, store, "acks") == []
    row = retention.exposed(store.read(spark, "rollups")).collect()
    assert len(row) == 1 and row[0]["event_count"] == 2 and row[0]["avg_temperature"] == 75.0
    assert store.status(spark).count() == 3                             # device states stay
    # re-delivered after deletion: new again, without the deleted reading before it
    ingest(spark, store, 1, [envelope(event("old1", device="d1", ts="2024-02-09T00:10:00Z", voltage=1.0)),
                             envelope(event("kept", device="d2", ts="2024-02-09T00:10:00Z"))])
    again = store.read(spark, "events").filter("event_id = 'old1'").collect()
    assert len(again) == 1 and not again[0]["voltage_drop_detected"]
    assert ids_of(spark, store) == ["kept", "new1", "old1"]


def test_records_and_acknowledgements(spark, monkeypatch):
    store = fresh()
    ingest(spark, store, 0, [envelope(event("a", device="d1", ts="2024-01-01T00:00:00.5Z")),
                             envelope(event("b", device="d2")), b"{bad", envelope(event("c", device="d1", region=""))])
    log, dead_log, raw = store.path("log"), store.path("dead"), store.path("raw")
    # a crash after sending and before marking: the same id is sent again
    monkeypatch.setattr(dispatch, "publish_acks", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        dispatch.dispatch_validated(spark, store, log, F.lit(LATER), limit=1)
    monkeypatch.undo()
    assert dispatch.dispatch_validated(spark, store, log, F.lit(LATER), limit=10) == 2
    assert dispatch.dispatch_validated(spark, store, log, F.lit(LATER), limit=10) == 0
    sent = sorted(record_log.read(spark, log).collect(), key=lambda r: (r["ack_id"], r["offset"]))
    assert [r["ack_id"] for r in sent] == ["a", "a", "b"]
    assert [bytes(r["key"]).decode() for r in sent] == ["d1", "d1", "d2"]
    assert all(bytes(r["headers"][0]["value"]).decode() == r["ack_id"] and r["headers"][0]["key"] == "event_id"
               for r in sent)
    assert json.loads(bytes(sent[0]["value"])) == {
        "event_id": "a", "device_id": "d1", "timestamp": "2024-01-01T00:00:00.500000Z", "avg_temperature_5m": 20.0,
        "voltage_drop_detected": False, "event_lag_ms": -400, "outlier_detected": False}
    assert json.loads(bytes(sent[2]["value"]))["timestamp"] == "2024-01-01T00:00:00Z"
    places = [(r["partition"], r["offset"]) for r in sent]
    assert len(set(places)) == 3 and sent[0]["partition"] == sent[1]["partition"] and sent[1]["offset"] == 1

    assert dispatch.dispatch_dead_letters(spark, store, dead_log, F.lit(LATER)) == 2
    assert dispatch.dispatch_dead_letters(spark, store, dead_log, F.lit(LATER)) == 0
    letters = {bytes(r["key"]).decode(): json.loads(bytes(r["value"])) for r in record_log.read(spark, dead_log).collect()}
    assert set(letters) == {"raw-telemetry:0:2", "raw-telemetry:0:3"}
    bad = letters["raw-telemetry:0:2"]
    assert bad["source"] == {"topic": "raw-telemetry", "partition": 0, "offset": 2}
    assert bad["payload"] == {"raw_base64": "e2JhZA=="} and bad["failed_at"] == "2024-03-01T00:00:00Z"
    assert bad["reason"].startswith("invalid JSON: ")

    asked = spark.createDataFrame([("raw-telemetry", 0, 2), ("raw-telemetry", 0, 3)],
                                  "source_topic string, source_partition int, source_offset bigint")
    fix = spark.createDataFrame([("raw-telemetry", 0, 3, json.dumps(envelope(event("c", device="d1"))))],
                                f"{'source_topic string, source_partition int, source_offset bigint'}, payload string")
    assert dispatch.replay_job(spark, store, asked, raw, F.lit(LATER), fix).filter("executed").count() == 0
    assert record_log.commits(spark, raw) == []                          # a dry run sends nothing
    plan = dispatch.replay_job(spark, store, asked, raw, F.lit(LATER), fix, execute=True)
    assert {r["next_replay_count"] for r in plan.collect()} == {1}
    assert {r["next_replay_count"] for r in dispatch.replay_job(spark, store, asked, raw, F.lit(LATER)).collect()} == {2}
    replayed = record_log.read(spark, raw)
    assert {bytes(r["headers"][0]["value"]).decode() for r in replayed.collect()} == set(letters)
    # the replayed records are raw deliveries again: the corrected one is stored, the bad one dead-letters anew
    process_batch(replayed.select("key", "value", "topic", "partition", "offset", "timestamp"), 1, store,
                  fixed_processing())
    assert ids_of(spark, store) == ["a", "b", "c"]
    missing = asked.withColumn("source_offset", F.lit(99).cast("bigint"))
    with pytest.raises(ValueError):
        dispatch.replay_job(spark, store, missing, raw, F.lit(LATER), execute=True)
