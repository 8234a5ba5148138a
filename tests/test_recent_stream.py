"""Recent lists as stream state: equal to the batch form, restart, expiry."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetline.operators.state import recent_events
from fleetline.plans.pipeline import ingest
from fleetline.streaming import recent
from tests.helpers import T0, deliveries, envelope, event, fixed_processing

DAY = int(T0.timestamp() * 1_000_000)


def add_file(spark, source, i, bodies):
    """One delivery file, appended after the others (one a micro-batch)."""
    part = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/part"
    deliveries(spark, bodies, start_offset=1000 * i, start_us=DAY + i * 600_000_000).coalesce(1).write.parquet(part)
    os.makedirs(source, exist_ok=True)
    name = [f for f in os.listdir(part) if f.endswith(".parquet")][0]
    os.link(os.path.join(part, name), os.path.join(source, f"b{i}.parquet"))


def rows(df):
    return sorted(map(tuple, df.select("device_id", "position", "event_id", "temperature").collect()))


def batch(i):
    bodies = [envelope(event(f"e{i}-{j}", device=f"d{j % 3}", temperature=float(j))) for j in range(70)]
    bodies += [b"{bad", envelope(event(f"e{max(i - 1, 0)}-5", device="other", temperature=99.0))]   # re-touches
    return bodies


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")         # a state store each
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def run(spark, source, store, checkpoint, **more):
    query = recent.start(spark, source, store, checkpoint, max_per_trigger=1, processing_time=fixed_processing(),
                         interval="0 seconds", **more)
    recent.run_until_idle(query, 200)


def test_three_batches_and_a_restart_equal_the_batch_form(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    source, store, checkpoint = f"{root}/log", recent.RecentStore(f"{root}/t", 2), f"{root}/ckpt"
    for i in range(2):
        add_file(spark, source, i, batch(i))
    run(spark, source, store, checkpoint)
    add_file(spark, source, 2, batch(2))
    run(spark, source, store, checkpoint)                      # restarts from its checkpoint
    done = ingest(spark.read.parquet(source), fixed_processing())
    want = recent_events(done.valid, done.events)
    assert rows(store.read(spark)) == rows(want)
    assert {r["device_id"] for r in want.collect()} == {"d0", "d1", "d2"}
    one = spark.createDataFrame([("d1",)], "device_id string")
    assert rows(store.read(spark, devices=one)) == [r for r in rows(want) if r[0] == "d1"]
    late = F.timestamp_micros(F.lit(DAY + 86_400_000_000 + 1_260_000_000))
    assert rows(store.read(spark, now=late)) == rows(recent_events(done.valid, done.events, now=late))
    store.add(store.read(spark).limit(0), 2)                   # a repeated batch is left alone
    assert rows(store.read(spark)) == rows(want)


def test_a_silent_device_expires(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    source, store, checkpoint = f"{root}/log", recent.RecentStore(f"{root}/t", 2), f"{root}/ckpt"
    add_file(spark, source, 0, [envelope(event("a", device="silent")), envelope(event("b", device="busy"))])
    run(spark, source, store, checkpoint, ttl_ms=1)
    assert store.read(spark).collect() == []                  # timers ran in the batch after the touches
    add_file(spark, source, 1, [envelope(event("c", device="busy"))])
    run(spark, source, store, checkpoint, ttl_ms=3_600_000)
    lists = {}
    for r in store.read(spark).collect():
        lists.setdefault(r["device_id"], []).append(r["event_id"])
    assert lists == {"busy": ["c"]}                           # the list begins anew
