"""Read queries over the event, state, ledger and dead-letter tables (Q1-Q13).

Every function takes the tables and explicit parameters (``now`` is a
Column, never ``current_timestamp()`` inside), and returns a DataFrame.
Top-k results use a total order (ties broken by a unique key) so the
result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetline.constants import (
    ALERTS_DEFAULT_LIMIT, ALERTS_MAX_LIMIT, DEVICE_HISTORY_DEFAULT_LIMIT, DEVICE_HISTORY_MAX_LIMIT,
    LATEST_DEVICES, LOW_VOLTAGE, OUTLIER_HIGH, OUTLIER_LOW, TREND_BUCKETS,
)
from fleetline.operators.enrich import EVENT_COLUMNS, EXACT


def _check_limit(limit: int, high: int) -> int:
    if not 1 <= limit <= high:
        raise ValueError(f"limit must be between 1 and {high}")
    return limit


def devices(status: DataFrame, region: str | None = None) -> DataFrame:
    """Q1: devices with region, last seen and status; empty region = no filter."""
    out = status.select("device_id", "region", "last_seen", "status")
    if region:
        out = out.filter(F.col("region") == region)
    return out.orderBy("device_id")


def device_history(events: DataFrame, device_id: str, start: Column | None = None,
                   end: Column | None = None, status: str | None = None,
                   limit: int = DEVICE_HISTORY_DEFAULT_LIMIT) -> DataFrame:
    """Q2: one device's events, inclusive time bounds, newest first, limited."""
    _check_limit(limit, DEVICE_HISTORY_MAX_LIMIT)
    cond = F.col("device_id") == device_id
    if start is not None:
        cond = cond & (F.col("timestamp") >= start)
    if end is not None:
        cond = cond & (F.col("timestamp") <= end)
    if status:
        cond = cond & (F.col("status") == status)
    return (events.filter(cond).select(*EVENT_COLUMNS)
            .orderBy(F.col("timestamp").desc(), F.col("event_id").desc()).limit(limit))


def latest_event(events: DataFrame, device_id: str) -> DataFrame:
    """Q3: the newest event of one device by event time (empty = not found)."""
    return (events.filter(F.col("device_id") == device_id).select(*EVENT_COLUMNS)
            .orderBy(F.col("timestamp").desc(), F.col("event_id").desc()).limit(1))


def latest_per_device(events: DataFrame) -> DataFrame:
    """Q3 fleet-wide: newest event per device (ties: later arrival).

    A max over a struct led by (timestamp, arrival): partial aggregation,
    so a hot device is reduced map-side.
    """
    packed = F.max(F.struct("timestamp", "source_partition", "source_offset",
                            *[F.col(c).alias(c) for c in EVENT_COLUMNS if c not in ("timestamp", "device_id")]))
    return events.groupBy("device_id").agg(packed.alias("_l")).select(
        "device_id", *[F.col(f"_l.{c}").alias(c) for c in EVENT_COLUMNS if c != "device_id"])


def pipeline_stats(events: DataFrame, dead_letters: DataFrame, ledger: DataFrame,
                   device_prefix: str | None = None) -> DataFrame:
    """Q5: event count (LIKE prefix: ``%`` and ``_`` stay wildcards), DLQ
    count, pending and published ledger rows.  One row."""
    ev = events
    if device_prefix:
        ev = ev.filter(F.col("device_id").like(device_prefix + "%"))
    e = ev.agg(F.count(F.lit(1)).alias("event_count"))
    d = dead_letters.agg(F.count(F.lit(1)).alias("dlq_count"))
    o = ledger.agg(F.count_if(F.col("published_at").isNull()).alias("outbox_pending_count"),
                   F.count_if(F.col("published_at").isNotNull()).alias("outbox_published_count"))
    return e.crossJoin(d).crossJoin(o)   # three one-row frames


def status_counts(status: DataFrame) -> DataFrame:
    """Q6: devices per status."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("count")).orderBy("status")


def region_health(status: DataFrame) -> DataFrame:
    """Q7: per region: devices, unhealthy (not OK), mean temperature and voltage."""
    return status.groupBy("region").agg(
        F.count(F.lit(1)).alias("devices"),
        F.count_if(F.col("status") != "OK").alias("unhealthy"),
        F.avg("temperature").alias("avg_temperature"),
        F.avg("voltage").alias("avg_voltage"),
    ).orderBy("region")


def exact_mean(name: str) -> Column:
    """Mean by a decimal sum: the same whatever order the rows are added in."""
    return F.sum(F.col(name).cast(EXACT)).cast("double") / F.count(name)


def minute_trend(events: DataFrame, row_cap: int | None = None,
                 buckets: int = TREND_BUCKETS) -> DataFrame:
    """Q8: minute buckets by processing time -> newest ``buckets`` buckets,
    ascending.  Failures = not OK; empty minutes are absent.  ``row_cap``
    (for example ``TREND_ROW_CAP``) reads the newest events only, so that the
    oldest bucket may be partial; by default every event counts."""
    recent = events.select("event_id", "processed_at", "status", "event_lag_ms", "temperature", "voltage")
    if row_cap is not None:
        recent = recent.orderBy(F.col("processed_at").desc(), F.col("event_id").desc()).limit(row_cap)
    per_minute = recent.groupBy(F.date_trunc("minute", "processed_at").alias("bucket")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("status") != "OK").alias("failures"),
        F.avg("event_lag_ms").alias("avg_lag_ms"),
        exact_mean("temperature").alias("avg_temperature"),
        exact_mean("voltage").alias("avg_voltage"),
    )
    return per_minute.orderBy(F.col("bucket").desc()).limit(buckets).orderBy("bucket")


def latest_seen_devices(status: DataFrame, n: int = LATEST_DEVICES) -> DataFrame:
    """Q9: the ``n`` devices seen last (ties by device id)."""
    return (status.select("device_id", "region", "last_seen", "status", "temperature", "voltage")
            .orderBy(F.col("last_seen").desc(), F.col("device_id")).limit(n))


def reliability_scalars(events: DataFrame, dead_letters: DataFrame, replays: DataFrame,
                        ledger: DataFrame, status: DataFrame, now: Column) -> DataFrame:
    """Q10: seven scalars, one aggregate per table, cross-joined one-row frames."""
    e = events.agg(F.count(F.lit(1)).alias("event_count"))
    d = dead_letters.agg(F.count(F.lit(1)).alias("dlq_count"))
    r = replays.agg(F.count(F.lit(1)).alias("replay_count"))
    pend = ledger.filter(F.col("published_at").isNull())
    o = pend.agg(F.count(F.lit(1)).alias("outbox_pending"),
                 F.min("created_at").alias("_oldest"))
    o = o.select("outbox_pending", F.coalesce(
        (F.unix_micros(now) - F.unix_micros("_oldest")) / F.lit(1e6), F.lit(0.0)).alias("oldest_outbox_seconds"))
    s = status.agg(
        F.count_if(F.col("voltage") < LOW_VOLTAGE).alias("low_voltage_devices"),
        F.count_if((F.col("temperature") < OUTLIER_LOW) | (F.col("temperature") > OUTLIER_HIGH))
        .alias("temperature_outliers"))
    return e.crossJoin(d).crossJoin(r).crossJoin(o).crossJoin(s)   # one-row frames


def region_summary(events: DataFrame, regions: DataFrame, now: Column) -> DataFrame:
    """Q11: last hour (``timestamp > now - 1 hour``, no upper bound) per requested
    region: events, distinct devices, means, failure rate (FAILED only).
    A requested region without rows gets ``event_count = 0``."""
    recent = events.filter(F.col("timestamp") > now - F.expr("INTERVAL 1 HOUR"))
    agg = recent.groupBy("region").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("device_id").alias("device_count"),
        F.avg("temperature").alias("avg_temperature"),
        F.avg("event_lag_ms").alias("avg_event_lag_ms"),
        F.avg(F.when(F.col("status") == "FAILED", 1).otherwise(0)).alias("failure_rate"),
    )
    return (regions.select("region").distinct().join(agg, "region", "left")
            .withColumn("event_count", F.coalesce("event_count", F.lit(0)).cast("bigint")))


def alert_filter() -> Column:
    return (F.col("status") != "OK") | F.col("outlier_detected") | F.col("voltage_drop_detected")


def alerts(events: DataFrame, limit: int = ALERTS_DEFAULT_LIMIT) -> DataFrame:
    """Q12: not OK, outlier or voltage drop; newest first; limited."""
    _check_limit(limit, ALERTS_MAX_LIMIT)
    return (events.filter(alert_filter()).select(*EVENT_COLUMNS)
            .orderBy(F.col("timestamp").desc(), F.col("event_id").desc()).limit(limit))


def fleet_summary(status: DataFrame) -> DataFrame:
    """Q13: dashboard tiles: per status count and share of the fleet, plus
    fleet totals (devices, unhealthy = not OK) on every row."""
    counts = status_counts(status)
    total = Window.partitionBy()   # over the few status rows only
    return counts.select(
        "status", F.col("count").alias("devices"),
        (F.lit(100.0) * F.col("count") / F.sum("count").over(total)).alias("share_pct"),
        F.sum("count").over(total).alias("device_total"),
        F.sum(F.when(F.col("status") != "OK", F.col("count")).otherwise(0)).over(total)
        .alias("unhealthy_total"))


def incident_list(events: DataFrame, fetched: int = 25, shown: int = 6) -> DataFrame:
    """Q13: first ``shown`` of the ``fetched`` newest alerts with a short code."""
    return (alerts(events, fetched).limit(shown)
            .select("event_id", "device_id", "region", "processed_at", "status",
                    F.when(F.col("status") == "FAILED", "ERR").otherwise("WRN").alias("code")))
