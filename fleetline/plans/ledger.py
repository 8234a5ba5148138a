"""Delivery-ledger jobs (T5-T8): claim, backlog, consumer lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.operators.state import pending


def claim_pending(ledger: DataFrame, acks: DataFrame, n: int) -> DataFrame:
    """T5: the oldest ``n`` pending rows in insertion order (created, event id).

    Row locks of a shared database are replaced by one dispatcher per
    checkpoint; the claim is a top-``n`` over the anti-joined ledger.
    """
    return pending(ledger, acks).orderBy("created_at", "event_id").limit(n)


def backlog(ledger: DataFrame, now: Column) -> DataFrame:
    """Pending rows and the age in seconds of the oldest one (0 if none)."""
    p = ledger.filter(F.col("published_at").isNull())
    return p.agg(F.count(F.lit(1)).alias("outbox_pending"), F.min("created_at").alias("_oldest")).select(
        "outbox_pending",
        F.coalesce((F.unix_micros(now) - F.unix_micros("_oldest")) / F.lit(1e6), F.lit(0.0))
        .alias("oldest_outbox_seconds"))


def partition_lag(routed: DataFrame, at: Column) -> DataFrame:
    """Per (topic, partition) at instant ``at``: high-water mark (next offset
    to be appended), committed position (first offset not yet processed; all
    before it are) and lag = max(highwater - position, 0)."""
    arrived = F.col("arrival_ts") <= at
    done = F.col("processed_at") <= at
    per = routed.groupBy("source_topic", "source_partition").agg(
        F.coalesce(F.max(F.when(arrived, F.col("source_offset"))) + 1, F.lit(0)).alias("highwater"),
        F.coalesce(F.min(F.when(~done, F.col("source_offset"))),
                   F.max("source_offset") + 1).alias("_first_open"))
    return per.select("source_topic", "source_partition", "highwater",
                      F.least("_first_open", "highwater").alias("position")) \
        .withColumn("lag", F.greatest(F.col("highwater") - F.col("position"), F.lit(0)))
