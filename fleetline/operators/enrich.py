"""First-wins storage and history enrichment.

History semantics: an event is enriched from the events *stored before it*
in arrival order (not event time), then filtered by event time.

* ``voltage_drop_detected`` compares with the stored row of greatest event
  time among earlier arrivals (ties: the later arrival), flag when
  ``previous - current >= 2.5``.
* ``avg_temperature_5m`` is the mean temperature of earlier arrivals with
  ``timestamp`` in ``[t - 5 min, t]``; own temperature when there is none.

Plan shape (no per-event correlated lookups, no all-pairs band join):

Arrival order is log order: (partition, offset).  A device's deliveries share
one partition; append times need not rise with offsets.

* previous voltage = running arg-max over arrival order, split by offset
  chunks so one hot device does not sit in one task
  (:func:`fleetline.operators.sequence.running_max_before`);
* the mean = (running sums over *all* stored rows of the device, where a row
  adds its value at its timestamp and takes it back just after 5 minutes,
  :func:`fleetline.operators.sequence.running_sums`) minus the row itself
  minus the rows that arrived *later* but lie in the window.  A row can only
  be such a later row if it is late (its timestamp is not above the newest
  earlier arrival), so the correction sums late rows only, by merge levels over
  (arrival, time) (:func:`fleetline.operators.sequence.later_in_band`).  Sums
  are decimals, so nothing is lost by taking back.  Work is O(n + l log l), l =
  rows in the 5-minute buckets that late rows reach; l = 0 for an in-order
  stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.constants import (
    OUTLIER_HIGH, OUTLIER_LOW, TRAILING_WINDOW_SECONDS, VOLTAGE_DROP_THRESHOLD,
)
from fleetline.operators.sequence import later_in_band, running_max_before, running_sums

WINDOW_US = TRAILING_WINDOW_SECONDS * 1000000
SUB_BUCKET_US = 30 * 1000000
OFFSET_CHUNK = 1 << 16                # a hot device is spread over chunks of its partition's offsets
EXACT = "decimal(18,14)"              # valid temperatures have three digits before the point

ARRIVAL_ORDER = ["source_partition", "source_offset", "arrival_ts"]

EVENT_COLUMNS = [
    "event_id", "device_id", "timestamp", "received_at", "processed_at", "temperature",
    "voltage", "status", "region", "avg_temperature_5m", "voltage_drop_detected",
    "event_lag_ms", "outlier_detected",
]


def first_arrivals(valid: DataFrame) -> DataFrame:
    """The first valid delivery of every ``event_id`` (global, first wins).

    A min over a struct led by the arrival order: a hash aggregate with
    map-side combine, so even one event id re-delivered many times is
    reduced before the shuffle (a ``row_number`` window would not be).
    """
    rest = [c for c in valid.columns if c not in ARRIVAL_ORDER and c != "event_id"]
    packed = F.min(F.struct(*[F.col(c) for c in ARRIVAL_ORDER], *[F.col(c) for c in rest]))
    return valid.groupBy("event_id").agg(packed.alias("_first")).select("event_id", "_first.*")


def lag_ms(processed_at, ts):
    """Milliseconds from event time to processing, truncated toward zero."""
    return F.expr(f"(unix_micros({processed_at}) - unix_micros({ts})) div 1000")


def _offset_chunk(order: Sequence[str]) -> Column:
    """Chunks along the arrival order: what comes before the offset, then its range."""
    offset = list(order).index("source_offset")
    return F.struct(*order[:offset], F.expr(f"source_offset div {OFFSET_CHUNK}").alias("offset_chunk"))


def previous_reading(stored: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Adds ``_prev`` = struct(ts_us, arrival..., voltage) of the newest earlier arrival."""
    with_us = stored.withColumn("_ts_us", F.unix_micros("timestamp"))
    value = F.struct(F.col("_ts_us").alias("ts_us"), *[F.col(c) for c in order],
                     F.col("voltage").alias("voltage"))
    return running_max_before(with_us, ["device_id"], order, chunk=_offset_chunk(order), value=value, out="_prev")


def _window_totals(stored: DataFrame) -> DataFrame:
    """Sum and count of temperatures of *all* stored rows of the device with
    timestamp in ``[t - 5 min, t]``, per event (the row itself included)."""
    own = stored.select("device_id", "event_id", F.unix_micros("timestamp").alias("_at"),
                        F.col("temperature").cast(EXACT).alias("_temp"), F.lit(1).alias("_one"))
    gone = own.select("device_id", F.lit(None).cast("string").alias("event_id"),
                      (F.col("_at") + WINDOW_US + 1).alias("_at"),
                      (-F.col("_temp")).cast(EXACT).alias("_temp"), F.lit(-1).alias("_one"))
    sums = running_sums(own.unionByName(gone), ["device_id"], "_at", SUB_BUCKET_US,
                        {"_a_sum": F.col("_temp"), "_a_n": F.col("_one")})
    return sums.filter("_one = 1").select("event_id", "_a_sum", "_a_n")


def _later_arrivals_in_window(rows: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Per event: sum and count of rows that arrived later yet lie in its window.

    ``rows`` are the stored rows with ``_prev``: late rows are those whose
    timestamp is not above the newest earlier arrival."""
    late = F.col("_prev").isNotNull() & (F.col("_ts_us") <= F.col("_prev.ts_us"))
    return later_in_band(rows, late, ["device_id"], "event_id", order, "_ts_us", WINDOW_US,
                         {"_b_sum": F.col("temperature").cast(EXACT), "_b_n": F.lit(1)})


def enrich(stored: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Enriched event rows (13 columns plus source coordinates) of stored events.

    ``stored`` holds the first delivery of every event with the typed event
    fields, ``received_at``, ``processed_at`` and the arrival order columns
    (``order`` may put a column before them).  It is read more than once
    (running arg-max, window totals), so it should be a materialised table, not
    a long lineage.
    """
    prev = previous_reading(stored, order)
    totals = _window_totals(stored)
    later = _later_arrivals_in_window(prev, order)
    joined = prev.join(totals, "event_id").join(later, "event_id", "left")
    n = F.col("_a_n") - 1 - F.coalesce(F.col("_b_n"), F.lit(0))
    s = (F.col("_a_sum") - F.col("temperature").cast(EXACT)
         - F.coalesce(F.col("_b_sum"), F.lit(0))).cast("double")
    return joined.select(
        "event_id", "device_id", "timestamp", "received_at", "processed_at",
        "temperature", "voltage", "status", "region",
        F.when(n > 0, s / n).otherwise(F.col("temperature")).alias("avg_temperature_5m"),
        F.coalesce(F.col("_prev.voltage") - F.col("voltage") >= VOLTAGE_DROP_THRESHOLD,
                   F.lit(False)).alias("voltage_drop_detected"),
        lag_ms("processed_at", "timestamp").alias("event_lag_ms"),
        ((F.col("temperature") < OUTLIER_LOW) | (F.col("temperature") > OUTLIER_HIGH))
        .alias("outlier_detected"),
        "source_topic", "source_partition", "source_offset", "arrival_ts",
    )
