"""Fixes of the fourth round's findings: the recent stream (F1)."""

import json
import re
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fleetline.operators import route as R
from fleetline.operators.state import recent_events
from fleetline.plans.catalog import write_table
from fleetline.plans.pipeline import ingest
from fleetline.streaming import recent
from tests.helpers import T0, deliveries, envelope, event, fixed_processing
from tests.test_recent_stream import add_file, rows


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_valid_rows_are_filtered_after_the_routing(spark):
    log = deliveries(spark, [envelope(event("a")), b"{bad", envelope(event("b", device=...))])
    ids = recent.touched(R.valid_deliveries(R.decided(R.route(log, fixed_processing()))))
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    filters = re.findall(r"Filter (.*)", plan)
    assert filters and not any("variant" in f for f in filters)
    assert [r["event_id"] for r in ids.collect()] == ["a"]


def test_lists_read_a_row_per_device_and_batch(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    source, store = f"{root}/log", recent.RecentStore(f"{root}/t", 2)
    one = [envelope(event(f"a{j}", device="hot", temperature=j + 0.1, voltage=11 + j / 1000)) for j in range(120)]
    one += [envelope(event("only", device="cold", ts="2024-01-01T00:00:00.123457Z"))]
    # an id pushed out of the list comes back, one still in it moves to the front, a new one is first
    two = [envelope(event(x, device="hot")) for x in ("a3", "a100", "new")] + [envelope(event("a4", device="elsewhere"))]
    three = [envelope(event(f"c{j}", device="hot")) for j in range(48)] + [envelope(event("a100", device="hot"))]
    for i, bodies in enumerate((one, two, three)):
        add_file(spark, source, i, bodies)
    query = recent.start(spark, source, store, f"{root}/ckpt", max_per_trigger=1,
                         processing_time=fixed_processing(), interval="0 seconds")
    recent.run_until_idle(query, 200)
    assert sum(p.numInputRows for p in query.lists.recentProgress) == 2 + 1 + 1
    done = ingest(spark.read.parquet(source), fixed_processing(), materialize=write_table)
    columns = ["device_id", "position", "event_id", "timestamp", "temperature", "voltage"]
    got, want = store.read(spark), recent_events(done.valid, done.events)
    assert rows(got) == rows(want) and got.count() == 51
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    last = {r["event_id"]: r["last_touch"]["arrival_ts"] for r in want.collect()}
    assert {r["event_id"]: r["arrival_ts"] for r in got.collect()} == last
    entries = store._table(spark).manifest.version().entries("recent")
    assert all(e["rows"] for e in entries)                       # no folder of a batch that ran for the timers alone


def test_a_hot_device_is_limited_before_it_is_dealt(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.range(0, 4000, 1, 4).selectExpr(
        "concat('e', id) as event_id", "'hot' as device_id", "timestamp_seconds(id) as timestamp", "1d as temperature",
        "2d as voltage", "0 as source_partition", "id as source_offset", "timestamp_seconds(id) as arrival_ts").write.parquet(f"{root}/touches")
    newest = recent.newest_touches(spark.read.parquet(f"{root}/touches"), 3)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.index("Exchange"):]                 # below the exchange
    [row] = newest.collect()
    assert [e["event_id"] for e in json.loads(row["entries"])] == ["e3999", "e3998", "e3997"]


def test_a_small_slice_is_a_batch_of_its_own(spark, monkeypatch):
    log = deliveries(spark, [envelope(event(i)) for i in "abcaed"], step_us=3_600_000_000)
    began, start = [], recent.start
    monkeypatch.setattr(recent, "start", lambda *a, **k: began.append(start(*a, **k)) or began[-1])
    lists = recent.replayed(spark, log, F.lit(T0), [(None, 2), (2, 4), (4, None)], "INTERVAL {} HOURS", files=5, partitions=2)
    assert [p.numInputRows for p in began[0].ids.recentProgress if p.numInputRows] == [2, 2, 2]
    assert [r["event_id"] for r in lists.orderBy("position").collect()] == list("deacb")


class Handle:
    """State of one key, and its timers."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return SimpleNamespace(get=lambda: self.value, update=lambda v: setattr(self, "value", v),
                               clear=lambda: setattr(self, "value", None))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_a_renewed_list_outlives_its_first_timer():
    handle = Handle()

    def at(now, ttl_ms):
        processor = recent.RecentList(2, ttl_ms)
        processor.init(handle)
        return processor, SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)

    def touch(now, *ids, ttl_ms=100):
        processor, clock = at(now, ttl_ms)
        row = {"batch": now, "entries": json.dumps([{"event_id": i} for i in ids])}
        [out] = processor.handleInputRows(("d",), iter([row]), clock)
        return [e["event_id"] for e in json.loads(out["entries"])]

    def fire(now):
        processor, clock = at(now, 100)
        out = []
        for timer in sorted(t for t in handle.timers if t <= now):
            handle.timers.remove(timer)
            info = SimpleNamespace(getExpiryTimeInMs=lambda timer=timer: timer)
            out += processor.handleExpiredTimer(("d",), clock, info)
        return [tuple(r) for r in out]

    assert touch(0, "b", "a") == ["b", "a"] and touch(60, "a") == ["a", "b"]
    assert fire(110) == [] and handle.timers == {160}             # renewed at 60
    assert touch(120, "c", ttl_ms=10) == ["c", "a"] and handle.timers == {130}
    assert fire(129) == [] and fire(131) == [("d", None)]
    assert handle.value is None and not handle.timers and touch(140, "z") == ["z"]
