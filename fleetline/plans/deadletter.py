"""Dead-letter triage and replay as data jobs.

The dead-letter table is keyed by source coordinates (topic, partition,
offset); a replay appends an audit row *after* the replayed delivery was
acknowledged, so ``replay_count`` is the number of audit rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.constants import DLQ_LIST_DEFAULT_LIMIT

COORDS = ["source_topic", "source_partition", "source_offset"]


def list_errors(dead: DataFrame, replays: DataFrame, limit: int = DLQ_LIST_DEFAULT_LIMIT) -> DataFrame:
    """L1: newest ``limit`` dead letters (insertion order = creation, coordinates)."""
    return (with_replays(dead, replays)
            .select(*COORDS, "reason", "created_at", "replay_count", "replayed_at")
            .orderBy(F.col("created_at").desc(), F.col("source_topic").desc(),
                     F.col("source_partition").desc(), F.col("source_offset").desc())
            .limit(limit))


def reason_class(reason: Column) -> Column:
    """The reason text before the first colon (the failure family)."""
    return F.trim(F.split(reason, ":").getItem(0))


def by_reason(dead: DataFrame) -> DataFrame:
    """L2: dead letters per reason family (triage before replay)."""
    return dead.groupBy(reason_class(F.col("reason")).alias("reason_class")).agg(
        F.count(F.lit(1)).alias("dead_letters"))


def restore(dead: DataFrame, *keep: str) -> DataFrame:
    """L3+L4: bytes to replay and the replay key.

    A payload whose key set is exactly ``{raw_base64}`` is decoded back to the
    original bytes; any other payload is replayed as its JSON text.  The key
    is ``event.device_id`` when present.  ``keep``: further columns to carry.
    """
    keys = F.json_object_keys("payload")
    raw = F.size(keys) == 1
    raw = raw & (keys.getItem(0) == "raw_base64")
    data = F.when(raw, F.unbase64(F.get_json_object("payload", "$.raw_base64"))) \
        .otherwise(F.encode("payload", "UTF-8"))
    key = F.get_json_object("payload", "$.event.device_id")
    return dead.select(*COORDS, *keep, "reason",
                       F.when(raw, "raw").otherwise("json").alias("restore_kind"),
                       data.alias("replay_bytes"),
                       F.when(key != "", key).alias("replay_key"))


def with_replays(dead: DataFrame, replays: DataFrame) -> DataFrame:
    """Dead letters with ``replay_count`` and last ``replayed_at`` from the audit log."""
    audit = replays.groupBy(*COORDS).agg(F.count(F.lit(1)).alias("replay_count"),
                                        F.max("replayed_at").alias("replayed_at"))
    return (dead.join(audit, COORDS, "left")
            .withColumn("replay_count", F.coalesce("replay_count", F.lit(0)).cast("bigint")))


def corrected(dead: DataFrame, corrections: DataFrame | None) -> DataFrame:
    """Dead letters with the payloads that ``corrections`` (coordinates,
    ``payload``) put in place of the stored ones."""
    if corrections is None:
        return dead
    return (dead.join(corrections.select(*COORDS, F.col("payload").alias("_fix")), COORDS, "left")
            .withColumn("payload", F.coalesce("_fix", "payload")).drop("_fix"))


def replay_plan(dead: DataFrame, replays: DataFrame, requested: DataFrame,
                corrections: DataFrame | None = None) -> DataFrame:
    """Dry-run report per requested coordinate: found or not, reason, bytes
    to send, next replay count, ``executed = false``.  A correction payload
    (same coordinates, column ``payload``) overrides the stored one."""
    restored = restore(corrected(with_replays(dead, replays), corrections), "replay_count")
    out = requested.select(*COORDS).join(restored, COORDS, "left")
    return out.select(
        *COORDS, F.col("reason").isNotNull().alias("found"), "reason",
        F.length("replay_bytes").alias("payload_bytes"),
        (F.col("replay_count") + 1).alias("next_replay_count"),
        F.lit(False).alias("executed"))


def replay_deliveries(dead: DataFrame, requested: DataFrame, topic: str, at: Column,
                      corrections: DataFrame | None = None) -> DataFrame:
    """L6 (send step): the deliveries a replay appends to the raw log, with the
    ``replay_error_id`` header; offsets are assigned by the log on append.
    Corrections apply as in :func:`replay_plan`."""
    r = restore(corrected(dead.join(requested.select(*COORDS), COORDS), corrections))
    return r.select(
        F.col("replay_key").cast("binary").alias("key"), F.col("replay_bytes").alias("value"),
        F.lit(topic).alias("topic"),
        F.array(F.struct(F.lit("replay_error_id").alias("key"),
                         F.concat_ws(":", *[F.col(c).cast("string") for c in COORDS]).cast("binary")
                         .alias("value"))).alias("headers"),
        at.alias("timestamp"))


def acknowledge(requested: DataFrame, acked: DataFrame, at: Column) -> DataFrame:
    """L6 (audit step): audit rows for the replays the log acknowledged."""
    return requested.select(*COORDS).join(acked.select(*COORDS), COORDS, "left_semi") \
        .withColumn("replayed_at", at)


def fixture_replays(dead: DataFrame, now: Column) -> DataFrame:
    """Replay history of the fixture: offsets ``% 3 = 0`` replayed once at ``now``,
    ``% 3 = 1`` twice (``now`` and one minute later), the rest never."""
    once = dead.filter(F.col("source_offset") % 3 == 0).select(*COORDS)
    twice = dead.filter(F.col("source_offset") % 3 == 1).select(*COORDS)
    first = acknowledge(once.unionByName(twice), once.unionByName(twice), now)
    second = acknowledge(twice, twice, now + F.expr("INTERVAL 60 SECONDS"))
    return first.unionByName(second)
