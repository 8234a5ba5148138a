"""Benchmark: ingest job + every registered query at $BENCH_SF_DIR.

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...},
 "sf": ..., "ingest_seconds": ..., "events_per_sec": ...}

The ingest (log -> route -> store -> enrich, tables written) is timed on its
own; ``events_per_sec`` is comparable with the reference's persisted-events
rate.  Each query is then timed end to end (plan + run + collect) over the
written tables.  A warm-up on sf0.001 absorbs JVM start-up and JIT.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fleetline.plans.catalog import catalog  # noqa: E402
from fleetline.plans.registry import REGISTRY  # noqa: E402
from fleetline.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    warm = "/root/testdata/sf0.001"
    if Path(warm).exists() and warm.rstrip("/") != sf_dir.rstrip("/"):
        for name in ("enriched_events", "alerts", "device_status"):
            REGISTRY[name](spark, warm).collect()

    t0 = time.time()
    cat = catalog(spark, sf_dir)
    _ = cat.ingest.events          # writes deliveries, routed, stored, events
    ingest_s = time.time() - t0
    events = cat.events.count()

    timings: dict[str, float] = {}
    for name, fn in REGISTRY.items():
        if name == "recent_50_stream":      # a stream of three micro-batches, no headline query
            continue
        t = time.time()
        fn(spark, sf_dir).collect()
        timings[name] = round(time.time() - t, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "ingest_seconds": round(ingest_s, 3),
        "stored_events": events,
        "events_per_sec": round(events / ingest_s, 1) if ingest_s else None,
    }))


if __name__ == "__main__":
    main()
