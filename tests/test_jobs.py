"""Retention drill, roll-up merge, dead-letter restore, percentiles, queries."""

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from fleetline.plans import deadletter as L
from fleetline.plans import queries as Q
from fleetline.plans import requests as B
from fleetline.plans import retention as RT


def ts(s):
    return datetime.fromisoformat(s.replace("Z", "+00:00")).astimezone(timezone.utc)


def test_retention_drill(spark):
    # 2 old delivered, 1 old pending, 1 recent; then a late old event in an existing hour
    ev = spark.createDataFrame([
        ("a", "d", ts("2024-01-01T00:10:00Z"), 70.0, 12.0, "OK", "r", 100),
        ("b", "d", ts("2024-01-01T00:20:00Z"), 70.0, 12.0, "OK", "r", 200),
        ("c", "d", ts("2024-01-01T00:30:00Z"), 90.0, 12.0, "OK", "r", 300),
        ("n", "d", ts("2024-01-09T00:00:00Z"), 60.0, 12.0, "OK", "r", 400),
    ], "event_id string, device_id string, timestamp timestamp, temperature double, voltage double, "
       "status string, region string, event_lag_ms bigint")
    ledger = spark.createDataFrame([
        ("a", ts("2024-01-01T00:10:01Z")), ("b", ts("2024-01-01T00:20:01Z")), ("c", None), ("n", None),
    ], "event_id string, published_at timestamp")
    cutoff = F.lit(ts("2024-01-02T00:00:00Z"))
    first = RT.run(ev, ledger, None, cutoff, 10, execute=True)
    rep = first.report.collect()[0]
    assert (rep["eligible_events"], rep["protected_pending_events"]) == (2, 1)
    assert (rep["selected_events"], rep["deleted_events"], rep["rollup_rows"]) == (2, 2, 1)
    RT.assert_report(rep)
    assert sorted(r["event_id"] for r in first.events.collect()) == ["c", "n"]
    late = spark.createDataFrame([("z", "d", ts("2024-01-01T00:40:00Z"), 80.0, 12.0, "OK", "r", 500)], ev.schema)
    late_ledger = spark.createDataFrame([("z", ts("2024-01-01T00:40:01Z"))], ledger.schema)
    second = RT.run(late, late_ledger, first.rollups, cutoff, 10, execute=True)
    row = RT.exposed(second.rollups).collect()[0]
    assert row["event_count"] == 3 and round(row["avg_temperature"], 1) == 73.3


def test_rollup_merge_weights_means(spark):
    a = spark.createDataFrame([(ts("2024-01-01T00:00:00Z"), "r", "OK", "d", 2, 140.0, 60.0, 80.0, 20.0, 9.0, 11.0,
                                10.0, ts("2024-01-01T00:00:00Z"), ts("2024-01-01T00:10:00Z"))],
                              RT.merge(None, RT.rollup(spark.createDataFrame(
                                  [("d", ts("2024-01-01T00:00:00Z"), 1.0, 1.0, "OK", "r", 1)],
                                  "device_id string, timestamp timestamp, temperature double, voltage double, "
                                  "status string, region string, event_lag_ms bigint"))).schema)
    b = a.withColumn("event_count", F.lit(1).cast("bigint")).withColumn("sum_temperature", F.lit(80.0))
    row = RT.exposed(RT.merge(a, b)).collect()[0]
    assert row["event_count"] == 3 and abs(row["avg_temperature"] - 220 / 3) < 1e-9


def test_restore_requires_exact_key_set(spark):
    dead = spark.createDataFrame([
        ("t", 0, 1, json.dumps({"raw_base64": "/3s="}), "invalid JSON: x"),
        ("t", 0, 2, json.dumps({"raw_base64": "/3s=", "x": 1}), "other"),
        ("t", 0, 3, json.dumps({"event": {"device_id": "d9"}}), "validation failed: x"),
    ], "source_topic string, source_partition int, source_offset bigint, payload string, reason string")
    rows = {r["source_offset"]: r for r in L.restore(dead).collect()}
    assert rows[1]["restore_kind"] == "raw" and bytes(rows[1]["replay_bytes"]) == b"\xff\x7b"
    assert rows[2]["restore_kind"] == "json"
    assert rows[3]["replay_key"] == "d9" and rows[1]["replay_key"] is None


def test_nearest_rank_is_half_even(spark):
    log = spark.createDataFrame([("a", 1, 1, 10.0), ("b", 1, 1, 20.0)],
                                "event_id string, concurrency int, run int, latency_ms double")
    row = B.nearest_rank(log, ["concurrency", "run"], "latency_ms", "event_id", [0.5, 0.99]).collect()[0]
    assert row["p50"] == 10.0 and row["p99"] == 20.0


def test_prefix_wildcards_and_default_region(spark):
    ev = spark.createDataFrame([("1", "sensor-1", ts("2024-01-01T05:30:00Z"), 1.0, "OK", 5, "r1"),
                                ("2", "sensorX2", ts("2024-01-01T05:30:00Z"), 1.0, "OK", 5, "r1")],
                               "event_id string, device_id string, timestamp timestamp, temperature double, "
                               "status string, event_lag_ms bigint, region string")
    empty = spark.createDataFrame([], "x int")
    ledger = spark.createDataFrame([], "event_id string, published_at timestamp")
    stats = Q.pipeline_stats(ev, empty, ledger, "sensor_").collect()[0]
    assert stats["event_count"] == 2
    asked = spark.createDataFrame([("r1",), ("nowhere",)], "region string")
    out = {r["region"]: r for r in Q.region_summary(ev, asked, F.lit(ts("2024-01-01T06:00:00Z"))).collect()}
    assert out["nowhere"]["event_count"] == 0 and out["r1"]["event_count"] == 2
