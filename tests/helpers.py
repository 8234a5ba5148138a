"""Small helpers for hand-written delivery rows."""

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from fleetline.streaming.job import DELIVERY_SCHEMA

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def event(eid, device="d1", ts="2024-01-01T00:00:00Z", temperature=20.0, voltage=12.0,
          status="OK", region="r1", **extra):
    e = {"event_id": eid, "device_id": device, "timestamp": ts, "temperature": temperature,
         "voltage": voltage, "status": status, "region": region}
    e.update(extra)
    return {k: v for k, v in e.items() if v is not ...}


def envelope(ev, version=1, schema_id=1, received_at="2024-01-01T00:00:00Z", **extra):
    env = {"event": ev, "received_at": received_at}
    if version is not None:
        env["schema_version"] = version
    if schema_id is not None:
        env["schema_id"] = schema_id
    env.update(extra)
    return env


def deliveries(spark, bodies, partition=0, start_offset=0, start_us=None, step_us=1_000_000):
    """Delivery rows in arrival order; ``bodies`` are dicts (JSON) or bytes."""
    base = int(T0.timestamp() * 1_000_000) if start_us is None else start_us
    rows = []
    for i, b in enumerate(bodies):
        value = b if isinstance(b, (bytes, bytearray)) else json.dumps(b).encode()
        rows.append((None, bytes(value), "raw-telemetry", partition, start_offset + i,
                     datetime.fromtimestamp((base + i * step_us) / 1e6, tz=timezone.utc)))
    return spark.createDataFrame(rows, DELIVERY_SCHEMA)


def fixed_processing(offset_us=100_000):
    return lambda df: F.timestamp_micros(F.unix_micros("arrival_ts") + F.lit(offset_us))
