"""Hand-written edge rows: decode, upcast, validation, enrichment, state."""

import json

from pyspark.sql import functions as F

from fleetline.operators import route as R
from fleetline.operators.state import device_status, recent_events
from fleetline.plans.pipeline import ingest
from tests.helpers import deliveries, envelope, event, fixed_processing


def routed_rows(spark, bodies):
    return {r["source_offset"]: r for r in R.route(deliveries(spark, bodies), fixed_processing()).collect()}


def test_invalid_bytes_keep_raw_base64(spark):
    r = routed_rows(spark, [b"\xff\x7b", b"{not-json"])
    assert r[0]["reason"].startswith("invalid JSON: ")
    assert json.loads(r[0]["payload"]) == {"raw_base64": "/3s="}
    assert json.loads(r[1]["payload"]) == {"raw_base64": "e25vdC1qc29u"}


def test_non_objects_are_dead_lettered_with_value(spark):
    r = routed_rows(spark, [b"[1]", b'"x"', b"3", b"null"])
    assert {x["reason"] for x in r.values()} == {"payload must be a JSON object"}
    assert [json.loads(r[i]["payload"]) for i in range(4)] == [{"value": [1]}, {"value": "x"}, {"value": 3},
                                                               {"value": None}]


def test_version_rules(spark):
    ev = event("e1")
    r = routed_rows(spark, [
        envelope(ev, version=None, schema_id=None),           # v0: upcast
        {"schema_version": None, "schema_id": 1, "event": ev, "received_at": "2024-01-01T00:00:00Z"},
        envelope(ev, version=0, schema_id=9),                  # explicit 0: schema id becomes 0
        envelope(ev, version=1, schema_id=None),               # v1 needs schema_id
        envelope(ev, version=999),
    ])
    assert r[0]["reason"] is None and r[0]["schema_id"] == 0 and r[0]["upcast"]
    assert r[1]["reason"] == "unsupported schema_version: None"
    assert r[2]["reason"] is None and r[2]["schema_id"] == 0
    assert r[3]["reason"] == "validation failed: schema_id: field required"
    assert r[4]["reason"] == "unsupported schema_version: 999"


def test_field_bounds_and_lengths(spark):
    ok = [event("a", temperature=-100, voltage=0), event("b", temperature=250, voltage=1000),
          event("c", temperature="72.4")]
    bad = [event(""), event("x" * 129), event("d", temperature=250.01), event("e", voltage=-0.1),
           event("f", status="BROKEN"), event("g", region=""), event("h", temperature=True),
           event("i", device_id=7), event("j", ts="2026")]
    r = routed_rows(spark, [envelope(e) for e in ok + bad])
    assert [r[i]["reason"] for i in range(3)] == [None, None, None]
    assert r[2]["temperature"] == 72.4
    for i in range(3, 3 + len(bad)):
        assert r[i]["reason"].startswith("validation failed: "), r[i]
    assert "event.event_id: length" in r[3]["reason"] and "event.event_id: length" in r[4]["reason"]


def test_all_errors_are_reported(spark):
    body = envelope({"event_id": "e", "device_id": "", "timestamp": "x", "temperature": 999,
                     "voltage": 1, "status": "OK", "region": "r"})
    errors = routed_rows(spark, [body])[0]["errors"]
    assert len(errors) == 3


def _ingest(spark, bodies, **kw):
    res = ingest(deliveries(spark, bodies, **kw), fixed_processing())
    return {r["event_id"]: r for r in res.events.collect()}, res


def test_enrichment_semantics(spark):
    bodies = [
        envelope(event("e1", ts="2024-01-01T00:00:00Z", temperature=10, voltage=12.5)),
        envelope(event("e2", ts="2024-01-01T00:05:00Z", temperature=20, voltage=10.0)),   # drop 2.5, 5 min edge
        envelope(event("e3", ts="2024-01-01T00:10:00Z", temperature=-40, voltage=10.0)),
        envelope(event("e4", ts="2024-01-01T00:02:00Z", temperature=140, voltage=20.0)),  # late
        envelope(event("e1", device="other", temperature=99)),                            # duplicate id
        envelope(event("e5", ts="2024-01-01T00:10:00Z", temperature=30, voltage=5.0)),    # tie on timestamp
    ]
    ev, res = _ingest(spark, bodies)
    assert set(ev) == {"e1", "e2", "e3", "e4", "e5"}
    assert ev["e1"]["avg_temperature_5m"] == 10 and not ev["e1"]["voltage_drop_detected"]
    assert ev["e1"]["device_id"] == "d1"
    assert ev["e2"]["avg_temperature_5m"] == 10 and ev["e2"]["voltage_drop_detected"]
    assert ev["e3"]["avg_temperature_5m"] == 20 and not ev["e3"]["outlier_detected"]
    # late event: history = e1, e2, e3; window [23:57, 00:02] holds only e1
    assert ev["e4"]["avg_temperature_5m"] == 10
    assert not ev["e4"]["voltage_drop_detected"]          # previous = e3 (newest), 10 - 20 < 2.5
    assert ev["e5"]["avg_temperature_5m"] == (20 - 40) / 2   # e2 at the 5-min edge and e3; not e4
    st = {r["device_id"]: r for r in res.device_status.collect()}
    assert st["d1"]["temperature"] == 30                   # same timestamp: the later arrival wins


def test_future_timestamp_gives_negative_lag(spark):
    body = envelope(event("f", ts="2024-01-01T00:00:00.0019Z"))
    res = ingest(deliveries(spark, [body]), lambda df: F.col("arrival_ts"))
    assert res.events.collect()[0]["event_lag_ms"] == -1


def test_recent_list_keeps_fifty_and_moves_retouched(spark):
    bodies = [envelope(event(f"e{i:02d}", ts=f"2024-01-01T00:{i:02d}:00Z")) for i in range(51)]
    bodies.append(envelope(event("e00", ts="2024-01-01T00:00:00Z")))   # re-delivery of the oldest
    res = ingest(deliveries(spark, bodies), fixed_processing())
    rec = {r["event_id"]: r["position"] for r in recent_events(res.valid, res.events).collect()}
    assert len(rec) == 50 and rec["e00"] == 1 and "e01" not in rec


def test_state_fold_is_incremental(spark):
    bodies = [envelope(event(f"e{i}", ts=f"2024-01-01T00:0{i % 3}:00Z", temperature=i)) for i in range(6)]
    res = ingest(deliveries(spark, bodies), fixed_processing())
    full = device_status(res.events).drop("_winner").collect()
    first = device_status(res.events.filter("source_offset < 3"))
    folded = device_status(res.events.filter("source_offset >= 3"), first).drop("_winner").collect()
    assert full == folded
