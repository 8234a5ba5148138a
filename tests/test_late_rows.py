"""Late rows of the five-minute mean: exact and near-linear under disorder."""

import random
import time

from pyspark.sql import functions as F

from fleetline.operators import enrich as E
from fleetline.operators.sequence import later_in_band
from tests.helpers import T0

DAY = int(T0.timestamp() * 1_000_000)
SCHEMA = "event_id string, device_id string, us long, temperature double, source_offset long"


def stored(spark, rows):
    at = F.timestamp_micros("us")
    return spark.createDataFrame(rows, SCHEMA).select(
        "*", at.alias("timestamp"), at.alias("received_at"), at.alias("processed_at"), at.alias("arrival_ts"),
        F.lit(12.0).alias("voltage"), F.lit("OK").alias("status"), F.lit("r").alias("region"),
        F.lit("t").alias("source_topic"), F.lit(0).alias("source_partition"))


def means(spark, rows):
    return {r["event_id"]: r["avg_temperature_5m"] for r in E.enrich(stored(spark, rows)).collect()}


def brute(rows):
    out = {}
    for i, (eid, device, us, temperature, _) in enumerate(rows):
        before = [r[3] for r in rows[:i] if r[1] == device and us - E.WINDOW_US <= r[2] <= us]
        out[eid] = sum(before) / len(before) if before else temperature
    return out


def test_disorder_of_every_kind_equals_brute_force(spark):
    rnd = random.Random(5)
    shapes = {
        "reversed": [DAY + (200 - i) * 5_000_000 for i in range(200)],
        "ties": [DAY + rnd.randint(0, 3) * 60_000_000 for _ in range(150)],
        "edges": [DAY + rnd.randint(0, 8) * E.WINDOW_US + rnd.randint(-1, 1) for _ in range(150)],
        "before-epoch": [rnd.randint(-900, 900) * 1_000_000 for _ in range(150)],
        "in-order": [DAY + i * 7_000_000 for i in range(100)],
    }
    rows = []
    for shape, times in shapes.items():
        rows += [(f"{shape}-{i}", shape, us, round(rnd.uniform(-90, 240), 3), len(rows) + i)
                 for i, us in enumerate(times)]
    got, want = means(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_offset_chunks_do_not_matter(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(f"e{i}", "d", DAY + rnd.randint(0, 600) * 1_000_000, float(i % 50), i) for i in range(300)]
    monkeypatch.setattr(E, "OFFSET_CHUNK", 16)
    got, want = means(spark, rows), brute(rows)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def reversed_backlog(spark, n):
    """One device, n readings within five minutes, newest first."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("event_id"), F.lit("d").alias("device_id"), F.col("id").alias("o"),
        (F.lit(DAY) + (n - F.col("id")) * (240_000_000 // n)).alias("at"),
        (F.col("id") % 90).cast("decimal(18,14)").alias("v"))


def banded(spark, n):
    rows = reversed_backlog(spark, n)
    return later_in_band(rows, F.lit(True), ["device_id"], "event_id", ["o"], "at", E.WINDOW_US,
                         {"total": F.col("v"), "n": F.lit(1)})


def test_reversed_backlog_grows_near_linearly(spark):
    banded(spark, 1000).agg(F.sum("n")).collect()                      # warm-up
    seconds = {}
    for n in (10_000, 40_000):
        start = time.perf_counter()
        pairs = banded(spark, n).agg(F.sum("n")).first()[0]
        seconds[n] = time.perf_counter() - start
        assert pairs == n * (n - 1) // 2                               # every later row lies in the band
    assert seconds[40_000] < 5 * seconds[10_000]


def test_rows_made_per_level_not_per_pair(spark):
    """800 million pairs come from some 40,000 x 16 rows."""
    metrics = banded(spark, 40_000)
    total = metrics.agg(F.sum("total"), F.count("event_id")).first()
    assert total[1] == 40_000 - 1                                      # the last arrival has none after it
