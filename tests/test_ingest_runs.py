"""Runs never destroy each other's rows, log order, exact means, nothing dropped."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetline.operators import enrich as E
from fleetline.plans import edge, requests
from fleetline.plans.contracts import conformance
from fleetline.plans.jobs import run_ingest
from fleetline.plans.pipeline import ingest
from fleetline.plans.queries import minute_trend
from fleetline.streaming import job
from tests.helpers import T0, deliveries, envelope, event, fixed_processing

DAY = int(T0.timestamp() * 1_000_000)


def _root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def _ids(store, spark, name="events"):
    return sorted(r["event_id"] for r in store.read(spark, name).collect())


def _two_logs(spark, root):
    first, second = os.path.join(root, "log1"), os.path.join(root, "log2")
    deliveries(spark, [envelope(event("a", temperature=10.0)), envelope(event("b", temperature=30.0)), b"{bad"]) \
        .write.parquet(first)
    deliveries(spark, [envelope(event("a", temperature=99.0)),
                       envelope(event("c", ts="2024-01-01T00:01:00Z", voltage=9.0))], start_us=DAY + 60_000_000) \
        .write.parquet(second)
    return first, second


def test_second_batch_run_keeps_the_first(spark):
    root = _root()
    first, second = _two_logs(spark, root)
    store = run_ingest(spark, first, f"{root}/t", fixed_processing())
    run_ingest(spark, second, f"{root}/t", fixed_processing())
    assert _ids(store, spark) == ["a", "b", "c"] == _ids(store, spark, "ledger")
    assert store.dead_letters(spark).count() == 1
    c = store.read(spark, "events").filter("event_id = 'c'").first()
    assert c["avg_temperature_5m"] == 20.0 and c["voltage_drop_detected"]   # the first run's a and b are its history
    assert store.read(spark, "events").filter("event_id = 'a'").first()["temperature"] == 10.0
    assert store.status(spark).first()["voltage"] == 9.0
    assert not os.path.exists(f"{root}/t/_work/0-0")


def test_failed_run_is_repeated_under_its_number(spark, monkeypatch):
    root = _root()
    first, second = _two_logs(spark, root)
    store = run_ingest(spark, first, f"{root}/t", fixed_processing())
    write = job.TableStore.write_batch

    def broken(self, df, name, run, batch_id):
        if name == "events":
            raise OSError("lost")
        write(self, df, name, run, batch_id)

    monkeypatch.setattr(job.TableStore, "write_batch", broken)
    with pytest.raises(OSError):
        run_ingest(spark, second, f"{root}/t", fixed_processing())
    monkeypatch.undo()
    run_ingest(spark, second, f"{root}/t", fixed_processing())
    assert _ids(store, spark) == ["a", "b", "c"] == _ids(store, spark, "ledger")
    assert store.read(spark, "runs").agg(F.max("run")).first()[0] == 1


def test_fresh_checkpoint_loses_nothing(spark):
    root = _root()
    first, second = _two_logs(spark, root)
    store = job.TableStore(f"{root}/t")
    for i, log in enumerate((first, second, second)):
        # the third run starts again with the checkpoint of the second: nothing is left to do
        job.start(spark, log, store, f"{root}/ckpt{min(i, 1)}", processing_time=fixed_processing()).awaitTermination(300)
    assert _ids(store, spark) == ["a", "b", "c"] == _ids(store, spark, "ledger")
    assert store.dead_letters(spark).count() == 1
    assert job.stream_run(spark, store, second, f"{root}/ckpt1") == 1


def test_log_order_beats_append_time(spark):
    log = deliveries(spark, [envelope(event("e1", temperature=10.0, voltage=12.0)),
                             envelope(event("e2", temperature=20.0, voltage=9.0))], step_us=-1_000_000)
    e2 = ingest(log, fixed_processing()).events.filter("event_id = 'e2'").first()
    assert e2["avg_temperature_5m"] == 10.0 and e2["voltage_drop_detected"]


def test_mean_equals_brute_force(spark):
    rnd = random.Random(3)
    rows = [(f"e{i}", rnd.choice("ab"), DAY + rnd.randint(0, 900) * 1_000_000, round(rnd.uniform(-90, 240), 3), i)
            for i in range(400)]
    stored = spark.createDataFrame(rows, "event_id string, device_id string, us long, temperature double, "
                                         "source_offset long").select(
        "*", F.timestamp_micros("us").alias("timestamp"), F.timestamp_micros("us").alias("received_at"),
        F.timestamp_micros("us").alias("processed_at"), F.timestamp_micros("us").alias("arrival_ts"),
        F.lit(12.0).alias("voltage"), F.lit("OK").alias("status"), F.lit("r").alias("region"),
        F.lit("t").alias("source_topic"), F.lit(0).alias("source_partition"))
    got = {r["event_id"]: r["avg_temperature_5m"] for r in E.enrich(stored).collect()}
    for eid, device, us, temperature, i in rows:
        before = [r[3] for r in rows[:i] if r[1] == device and us - E.WINDOW_US <= r[2] <= us]
        want = sum(before) / len(before) if before else temperature
        assert abs(got[eid] - want) < 1e-9


def test_split_answers_every_request(spark):
    good = ('{"device_id":"d","timestamp":"2024-01-01T00:00:00Z","temperature":20,"voltage":12,'
            '"status":"OK","region":"r"%s}')
    frame = spark.createDataFrame(
        [(1, [good % ""] * 501), (2, []), (3, [good % "", "{}", good % ',"event_id":null']), (4, [good % ""] * 500),
         (5, None)], "request_id long, events array<string>")
    rows = {r["request_id"]: r for r in edge.split_batches(frame).collect()}
    seen = {k: (r["submitted"], r["admitted"], r["accepted"], r["rejected"], r["rejected_positions"])
            for k, r in rows.items()}
    assert seen == {1: (501, False, 0, 501, ""), 2: (0, True, 0, 0, ""), 3: (3, True, 1, 2, "1,2"),
                    4: (500, True, 500, 0, ""), 5: (0, True, 0, 0, "")}
    assert rows[3]["rejections"][1]["error"] == "event_id: input should be a valid string"


def test_reconcile_counts_both_sides(spark):
    log = spark.createDataFrame([("a", 1, 0), ("b", 1, 0), ("c", 1, 0)], "event_id string, concurrency int, run int")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "event_id string")
    rows = {r["run"]: tuple(r)[2:] for r in requests.reconcile(log, ids("a", "b"), ids("a", "c", "z")).collect()}
    assert rows == {0: (2, 1, 1, 1), None: (0, 0, 0, 1)}


def test_trend_counts_every_event(spark):
    events = spark.range(300).select(
        F.col("id").cast("string").alias("event_id"), F.timestamp_micros(F.col("id") * 6_000_000).alias("processed_at"),
        F.lit("OK").alias("status"), F.lit(1).alias("event_lag_ms"), F.lit(1.0).alias("temperature"),
        F.lit(1.0).alias("voltage"))
    assert [r["events"] for r in minute_trend(events).collect()] == [10] * 12
    assert sum(r["events"] for r in minute_trend(events, row_cap=15).collect()) == 15


def test_numbers_and_schema_ids(spark):
    def routed(**kw):
        e = {k: kw.pop(k) for k in ("temperature",) if k in kw}
        return envelope(event("x", **e), **kw)
    bodies = [routed(temperature="72.4"), routed(temperature="72.4d"), routed(schema_id="7"), routed(schema_id=7.0),
              routed(schema_id=7.5), routed(schema_id=None)]
    log = deliveries(spark, bodies)
    reasons = {r["source_offset"]: r["reason"] for r in ingest(log, fixed_processing()).routed.collect()}
    assert [reasons[i] is None for i in range(6)] == [True, False, True, True, False, False]
    strict = {i: conformance(log.filter(F.col("offset") == i)).first()["conforming"] for i in range(6)}
    # the published contract wants JSON numbers and leaves the v1 schema id out if it likes
    assert strict == {0: False, 1: False, 2: False, 3: True, 4: False, 5: True}
