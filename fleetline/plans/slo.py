"""Operational metrics and SLO evaluation as data jobs (M1-M6).

Metrics are computed from the tables (or from any ``metric_samples`` frame
``metric, ts, value``), not scraped: counters are aggregates, histograms
are bucket counts, quantiles interpolate inside buckets like
``histogram_quantile``, and alert rules become gaps-and-islands over the
per-sample condition with a hold time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetline.constants import (
    DLQ_RATIO_FLOOR, PERSISTENCE_LATENCY_BUCKETS_S, PROCESSING_LATENCY_BUCKETS_MS,
)

# --- fixed values: bucket labels of the persistence-latency histogram ---------
BUCKET_LABELS = ("0.05", "0.1", "0.25", "0.5", "1", "2", "5", "10", "30", "60", "+Inf")


def counters(deliveries: DataFrame, valid: DataFrame, events: DataFrame, dead: DataFrame) -> DataFrame:
    """M1: ingested deliveries, processed (inserted), failed (dead-lettered),
    duplicates (valid deliveries not inserted).  One row."""
    d = deliveries.agg(F.count(F.lit(1)).alias("ingested"))
    v = valid.agg(F.count(F.lit(1)).alias("_valid"))
    e = events.agg(F.count(F.lit(1)).alias("processed"))
    f = dead.agg(F.count(F.lit(1)).alias("failed"))
    return (d.crossJoin(v).crossJoin(e).crossJoin(f)   # one-row frames
            .select("ingested", "processed", "failed", (F.col("_valid") - F.col("processed")).alias("duplicates")))


def _latency_us(events: DataFrame) -> Column:
    return F.greatest(F.unix_micros("processed_at") - F.unix_micros("received_at"), F.lit(0))


def _bucket_index(latency_us: Column, bounds_s: Sequence[float]) -> Column:
    """Index of the first bucket whose upper bound holds the value (last = +Inf)."""
    idx = F.lit(len(bounds_s))
    for i in reversed(range(len(bounds_s))):
        idx = F.when(latency_us <= F.lit(int(round(bounds_s[i] * 1e6))), F.lit(i)).otherwise(idx)
    return idx


def latency_histogram(events: DataFrame, by: Sequence[Column] = ()) -> DataFrame:
    """M2: cumulative ``le`` bucket counts of accepted-to-persisted latency."""
    return histogram(events, _latency_us(events), PERSISTENCE_LATENCY_BUCKETS_S, BUCKET_LABELS, by)


def request_latency_histogram(log: DataFrame, by: Sequence[Column] = ()) -> DataFrame:
    """M2: cumulative bucket counts of request latencies in milliseconds."""
    labels = [*map(str, PROCESSING_LATENCY_BUCKETS_MS), "+Inf"]
    return histogram(log, F.col("latency_ms") * 1e6, PROCESSING_LATENCY_BUCKETS_MS, labels, by)


def histogram(rows: DataFrame, value_millionths: Column, upper_bounds: Sequence[float], bucket_labels: Sequence[str],
              by: Sequence[Column] = ()) -> DataFrame:
    """Cumulative bucket counts of a value given in millionths of the bounds' unit.

    Each row is counted once in its own bucket (a partial aggregation), then
    the small bucket table is cumulated; no rows x bounds cross join.
    """
    per = rows.groupBy(*by, _bucket_index(value_millionths, upper_bounds).alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("n"))
    labels = F.array(*[F.lit(x) for x in bucket_labels])
    bounds = F.array(*[F.lit(float(b)) for b in upper_bounds], F.lit(float("inf")))
    grid = rows.sparkSession.range(len(bucket_labels)).select(F.col("id").cast("int").alias("bucket"))
    keys = [c for c in per.columns if c not in ("bucket", "n")]
    if keys:
        grid = per.select(*keys).distinct().crossJoin(grid)   # keys x buckets
    full = grid.join(per, [*keys, "bucket"], "left").fillna(0, ["n"])
    w = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return full.select(*keys, "bucket", F.element_at(labels, F.col("bucket") + 1).alias("le"),
                       F.element_at(bounds, F.col("bucket") + 1).alias("upper"),
                       F.sum("n").over(w).alias("count"))


def histogram_quantile(hist: DataFrame, q: float, keys: Sequence[str] = ()) -> DataFrame:
    """M3: ``histogram_quantile(q)`` over cumulative buckets: linear
    interpolation inside the bucket holding rank ``q * total``; a rank in the
    +Inf bucket returns the highest finite bound; no observations -> NULL."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("bucket")
    total = F.max("count").over(Window.partitionBy(*keys))
    staged = hist.select(*keys, "bucket", "upper", "count",
                         F.coalesce(F.lag("count").over(w), F.lit(0)).alias("below"),
                         F.coalesce(F.lag("upper").over(w), F.lit(0.0)).alias("lower"),
                         F.lag("upper").over(w).alias("prev_upper"),
                         (total * F.lit(q)).alias("rank"), total.alias("total"))
    hit = staged.filter((F.col("count") >= F.col("rank")) & (F.col("total") > 0))
    first = Window.partitionBy(*keys).orderBy("bucket")
    chosen = hit.withColumn("_r", F.row_number().over(first)).filter("_r = 1")
    value = F.when(F.col("upper") == float("inf"), F.col("prev_upper")).otherwise(
        F.col("lower") + (F.col("upper") - F.col("lower"))
        * (F.col("rank") - F.col("below")) / (F.col("count") - F.col("below")))
    return chosen.select(*keys, F.lit(q).alias("quantile"), value.alias("seconds"))


def event_rate(events: DataFrame) -> DataFrame:
    """M4: processed events per second in each processing minute."""
    return events.groupBy(F.date_trunc("minute", "processed_at").alias("minute")).agg(
        F.count(F.lit(1)).alias("events")).withColumn("per_second", F.col("events") / F.lit(60.0))


def _marks(events: DataFrame, dead: DataFrame) -> DataFrame:
    return (events.select(F.col("processed_at").alias("ts"), F.lit(1).alias("ok"), F.lit(0).alias("bad"))
            .unionByName(dead.select(F.col("created_at").alias("ts"), F.lit(0).alias("ok"), F.lit(1).alias("bad"))))


def dlq_ratio(events: DataFrame, dead: DataFrame, minutes: int = 10) -> DataFrame:
    """M5: dead letters / max(processed + dead letters, 0.001) per tumbling window."""
    w = F.window("ts", f"{minutes} minutes")
    agg = _marks(events, dead).groupBy(w.start.alias("window_start")).agg(
        F.sum("ok").cast("bigint").alias("processed"), F.sum("bad").cast("bigint").alias("dead_letters"))
    ratio = F.col("dead_letters") / F.greatest(F.col("processed") + F.col("dead_letters"), F.lit(DLQ_RATIO_FLOOR))
    return agg.withColumn("dlq_ratio", ratio).withColumn("breach", F.col("dlq_ratio") > DLQ_RATIO_FLOOR)


def minute_grid(start: Column, end: Column, spark_frame: DataFrame) -> DataFrame:
    """Sample instants every minute from ``start`` to ``end`` (both floored)."""
    one = spark_frame.sparkSession.range(1)
    return one.select(F.explode(F.sequence(F.date_trunc("minute", start), F.date_trunc("minute", end),
                                           F.expr("INTERVAL 1 MINUTE"))).alias("ts"))


def dlq_ratio_samples(events: DataFrame, dead: DataFrame, grid: DataFrame, minutes: int = 10) -> DataFrame:
    """Per sample instant t: the ratio over ``(t - minutes, t]`` from per-minute counts."""
    per_min = _marks(events, dead).groupBy(
        (F.floor((F.unix_micros("ts") - 1) / 60000000) + 1).alias("m")).agg(  # minute ending at or after ts
        F.sum("ok").alias("ok"), F.sum("bad").alias("bad"))
    g = grid.select("ts", (F.unix_micros("ts") / 60000000).cast("bigint").alias("m"))
    joined = g.join(per_min, "m", "left").fillna(0, ["ok", "bad"])
    w = Window.orderBy("m").rangeBetween(-(minutes - 1), 0)   # the grid is small (minutes x rules)
    ok, bad = F.sum("ok").over(w), F.sum("bad").over(w)
    return joined.select(F.lit("dead_letter_ratio").alias("metric"), "ts",
                         (bad / F.greatest(ok + bad, F.lit(DLQ_RATIO_FLOOR))).alias("value"))


LEVELS = 26                     # dyadic ranges up to 2^26 minutes: all minutes until the year 2097


def _power(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def dyadic_cover(low: Column, high: Column) -> Column:
    """The dyadic ranges ``(level, index)`` that together are ``[low, high)``:
    at most two of each level, those of a segment tree over the integers."""
    def at(level: Column) -> Column:
        size = _power(level)
        first, last = F.ceil(low / size), F.floor(high / size)
        odd_first = (first < last) & (first % 2 == 1)
        odd_last = (first + odd_first.cast("bigint") < last) & (last % 2 == 1)
        node = lambda index: F.struct(level.alias("level"), index.cast("bigint").alias("index"))
        return F.array_compact(F.array(F.when(odd_first, node(first)), F.when(odd_last, node(last - 1))))
    # low / size is exact in doubles: minutes stay far below 2^53
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))


def interval_minimum(intervals: DataFrame, low: str, high: str, value: str, points: DataFrame, point: str) -> DataFrame:
    """``points`` with ``_min``: the least ``value`` of the intervals
    ``[low, high)`` that hold the point (null if none does).

    An interval is written to the at most 2 log(length) dyadic ranges that
    cover it, a point looks at the ranges above it, one a level: an outage of a
    day costs a ledger row some twenty rows, not one per minute."""
    nodes = intervals.filter(F.col(low) < F.col(high)).select(
        F.explode(dyadic_cover(F.col(low), F.col(high))).alias("_n"), F.col(value).alias("_v")) \
        .groupBy("_n").agg(F.min("_v").alias("_v"))
    above = points.select(point).distinct().withColumn("_n", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS)),
        lambda level: F.struct(level.alias("level"),
                               F.floor(F.col(point) / _power(level)).alias("index")))))
    least = above.join(nodes, "_n").groupBy(point).agg(F.min("_v").alias("_min"))
    return points.join(least, point, "left")


def oldest_pending_samples(ledger: DataFrame, grid: DataFrame) -> DataFrame:
    """Per sample instant t: age of the oldest ledger row pending at t
    (created <= t and not yet published at t); 0 when none."""
    minute = lambda c: F.ceil(F.unix_micros(c) / 60000000)
    open_ = ledger.select("created_at", minute("created_at").alias("_low"), F.coalesce(
        minute("published_at"), F.lit(1 << LEVELS).cast("bigint")).alias("_high"))
    open_ = open_.groupBy("_low", "_high").agg(F.min("created_at").alias("created_at"))
    g = grid.select("ts", (F.unix_micros("ts") / 60000000).cast("bigint").alias("m"))
    both = interval_minimum(open_, "_low", "_high", "created_at", g, "m")
    return both.select(F.lit("outbox_oldest_pending_seconds").alias("metric"), "ts",
                       F.coalesce((F.unix_micros("ts") - F.unix_micros("_min")) / F.lit(1e6), F.lit(0.0))
                       .alias("value"))


def alert_states(samples: DataFrame, rules: Sequence[tuple[str, str, str, float, int]]) -> DataFrame:
    """M6: per rule and sample: condition, and state inactive / pending / firing.

    ``rules`` = (alert, metric, op, threshold, hold seconds).  Consecutive
    true samples form an island; it fires once it has held for the hold time.
    """
    spark = samples.sparkSession
    rule_df = spark.createDataFrame(list(rules), "alert string, metric string, op string, threshold double, hold_s int")
    s = samples.join(F.broadcast(rule_df), "metric")   # rules: a fixed handful of rows
    cond = F.when(F.col("op") == ">", F.col("value") > F.col("threshold")) \
        .otherwise(F.col("value") < F.col("threshold"))
    return _states(s.withColumn("condition", F.coalesce(cond, F.lit(False))))


def _states(staged: DataFrame) -> DataFrame:
    """State of every sample from ``condition`` and ``hold_s``."""
    w = Window.partitionBy("alert").orderBy("ts")
    staged = staged \
        .withColumn("_flip", F.when(F.col("condition") != F.coalesce(F.lag("condition").over(w), F.lit(False)), 1)
                    .otherwise(0))
    staged = staged.withColumn("_island", F.sum("_flip").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.min("ts").over(Window.partitionBy("alert", "_island"))
    held = F.unix_micros("ts") - F.unix_micros(start)
    state = F.when(~F.col("condition"), "inactive") \
        .when(held >= F.col("hold_s") * F.lit(1000000), "firing").otherwise("pending")
    return staged.select("alert", "ts", "value", "condition", state.alias("state"))


def evaluate_rules(samples: DataFrame, grid: DataFrame, rules: Sequence[tuple[str, str, str, str, float, int]],
                   when_absent: Sequence[str] = ()) -> DataFrame:
    """M6 + M7: every rule at every instant of ``grid``.

    ``samples``: (metric, ts, value), a row per label set; ``rules``: (alert,
    metric, aggregate over label sets, op, threshold, hold seconds).  A rule
    named in ``when_absent`` holds where its metric has no sample at all; any
    other does not hold there.
    """
    spark = samples.sparkSession
    rule_df = spark.createDataFrame(
        [(*r, r[0] in when_absent) for r in rules],
        "alert string, metric string, agg string, op string, threshold double, hold_s int, absent boolean")
    over = samples.groupBy("metric", "ts").agg(
        F.max("value").alias("_max"), F.min("value").alias("_min"), F.sum("value").alias("_sum"))
    expected = grid.select("ts").crossJoin(F.broadcast(rule_df))        # instants x a handful of rules
    s = expected.join(over, ["metric", "ts"], "left").withColumn(
        "value", F.when(F.col("agg") == "max", F.col("_max")).when(F.col("agg") == "min", F.col("_min"))
        .otherwise(F.col("_sum")))
    cond = F.when(F.col("value").isNull(), F.col("absent")).when(F.col("op") == ">", F.col("value") > F.col("threshold")) \
        .otherwise(F.col("value") < F.col("threshold"))
    return _states(s.withColumn("condition", cond))


def counter_increase(samples: DataFrame, keys: Sequence[str], minutes: int) -> DataFrame:
    """Increase of counters (keys, ts, value; a sample a minute) over the last
    ``minutes``: the sum of the steps, where a counter below its predecessor
    has begun again at zero.  A counter's first sample is a step from zero."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("_m")                         # a series: one row a minute
    before = F.coalesce(F.lag("value").over(w), F.lit(0))
    step = F.when(F.col("value") >= before, F.col("value") - before).otherwise(F.col("value"))
    m = (F.unix_micros("ts") / 60000000).cast("bigint")
    return (samples.withColumn("_m", m).withColumn("_step", step)
            .withColumn("increase", F.sum("_step").over(w.rangeBetween(-(minutes - 1), 0))).drop("_m", "_step"))


def persistence_p99(counters: DataFrame, minutes: int = 5) -> DataFrame:
    """p99 per instant from cumulative bucket counters (worker, bucket, upper,
    ts, value): increases over ``minutes``, summed over workers, interpolated."""
    per = counter_increase(counters, ["worker", "bucket", "upper"], minutes)
    summed = per.groupBy("ts", "bucket", "upper").agg(F.sum("increase").alias("count"))
    return histogram_quantile(summed, 0.99, ["ts"]).select(
        F.lit("persistence_p99_seconds").alias("metric"), "ts", F.col("seconds").alias("value"))


def bucket_counters(events: DataFrame, grid: DataFrame, restart_minute: Column) -> DataFrame:
    """Cumulative latency counters per worker (source partition) at every grid
    minute, as a worker exports them: they begin again after ``restart_minute``."""
    per = events.groupBy(
        F.col("source_partition").alias("worker"), _bucket_index(_latency_us(events), PERSISTENCE_LATENCY_BUCKETS_S)
        .alias("_own"), F.ceil(F.unix_micros("processed_at") / 60000000).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    spark = events.sparkSession
    bounds = F.array(*[F.lit(float(b)) for b in PERSISTENCE_LATENCY_BUCKETS_S], F.lit(float("inf")))
    buckets = spark.range(len(BUCKET_LABELS)).select(
        F.col("id").cast("int").alias("bucket"), F.element_at(bounds, F.col("id").cast("int") + 1).alias("upper"))
    g = grid.select("ts", (F.unix_micros("ts") / 60000000).cast("bigint").alias("m"))
    cells = per.select("worker").distinct().crossJoin(F.broadcast(buckets)).crossJoin(g)   # workers x 11 x minutes
    counted = per.join(F.broadcast(buckets), F.col("_own") <= F.col("bucket")).groupBy("worker", "bucket", "m").agg(
        F.sum("n").alias("n"))
    run = (F.col("m") > restart_minute).cast("int")
    w = Window.partitionBy("worker", "bucket", run).orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    return cells.join(counted, ["worker", "bucket", "m"], "left").select(
        "worker", "bucket", "upper", "ts", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("value"))


def lag_samples(routed: DataFrame, grid: DataFrame) -> DataFrame:
    """M7: consumer lag per source partition at every sample instant, and its sum.

    highwater(t) = deliveries appended by t (offsets are dense from 0);
    position(t) = first offset not processed by t (a suffix minimum over the
    processing minutes), capped by highwater.  Both are scans over the small
    (partition x minute) grid, not over rows.
    """
    g = grid.select("ts", (F.unix_micros("ts") / 60000000).cast("bigint").alias("m"))
    parts = routed.select("source_topic", "source_partition").distinct()
    cells = parts.crossJoin(g)                       # partitions x minutes
    arrived = routed.groupBy("source_topic", "source_partition",
                             F.ceil(F.unix_micros("arrival_ts") / 60000000).alias("m")).agg(
        F.count(F.lit(1)).alias("arrivals"))
    open_until = routed.groupBy("source_topic", "source_partition",
                                (F.ceil(F.unix_micros("processed_at") / 60000000) - 1).alias("m")).agg(
        F.min("source_offset").alias("first_open"))
    total = routed.groupBy("source_topic", "source_partition").agg(F.count(F.lit(1)).alias("total"))
    key = ["source_topic", "source_partition"]
    j = cells.join(arrived, [*key, "m"], "left").join(open_until, [*key, "m"], "left").join(total, key)
    upto = Window.partitionBy(*key).orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*key).orderBy("m").rowsBetween(0, Window.unboundedFollowing)
    hw = F.coalesce(F.sum("arrivals").over(upto), F.lit(0))
    pos = F.coalesce(F.min("first_open").over(after), F.col("total"))
    per = j.select(*key, "ts", hw.alias("highwater"), pos.alias("_pos"))
    per = per.withColumn("position", F.least("_pos", "highwater")).drop("_pos") \
        .withColumn("lag", F.greatest(F.col("highwater") - F.col("position"), F.lit(0)))
    return per


def lag_gauge(routed: DataFrame, grid: DataFrame) -> DataFrame:
    """M7 gauges per sample: sum and max of partition lag (alert input)."""
    per = lag_samples(routed, grid)
    return per.groupBy("ts").agg(F.sum("lag").alias("queue_lag_sum"), F.max("lag").alias("queue_lag_max"))
