"""Retention with hourly roll-ups.

Events older than the cutoff whose ledger row was delivered are rolled up
into hourly (bucket, region, status, device) rows and then deleted; events
with a pending ledger row are protected.  A roll-up merge adds counts and
re-weights the means, so a late batch never replaces an earlier one.  The
job returns new table versions plus a one-row report; the caller publishes
them only after the count check passed.  :func:`run_job` is that caller over
an ingest store: everything it changes appears in one published version.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetline.plans.pipeline import Materialize, lazy
from fleetline.operators.state import ledger_with_acks
from fleetline.streaming.job import TableStore, delete, newest_readings
from fleetline.tables.manifest import Change, Manifest, Version

ROLLUP_KEYS = ["bucket_start", "region", "status", "device_id"]
_MEASURES = {"temperature": "temperature", "voltage": "voltage", "event_lag_ms": "event_lag_ms"}


def _candidates(events: DataFrame, ledger: DataFrame, cutoff: Column) -> DataFrame:
    return (events.filter(F.col("timestamp") < cutoff)
            .join(ledger.select("event_id", "published_at"), "event_id"))


def inspect(events: DataFrame, ledger: DataFrame, cutoff: Column) -> DataFrame:
    """Eligible (delivered) and protected (pending) old events, and the
    oldest/newest eligible timestamp.  One row."""
    c = _candidates(events, ledger, cutoff)
    delivered = F.col("published_at").isNotNull()
    return c.agg(
        F.count_if(delivered).alias("eligible_events"),
        F.count_if(~delivered).alias("protected_pending_events"),
        F.min(F.when(delivered, F.col("timestamp"))).alias("oldest_event"),
        F.max(F.when(delivered, F.col("timestamp"))).alias("newest_event"),
    )


def select_batch(events: DataFrame, ledger: DataFrame, cutoff: Column, batch_size: int | None) -> DataFrame:
    """R2: delivered old events in (timestamp, event_id) order, at most
    ``batch_size`` (``None`` = all eligible in one pass)."""
    if batch_size is not None and batch_size < 1:
        raise ValueError("batch size must be positive")
    c = _candidates(events, ledger, cutoff).filter(F.col("published_at").isNotNull()).drop("published_at")
    if batch_size is None:
        return c
    return c.orderBy("timestamp", "event_id").limit(batch_size)


def rollup(events: DataFrame) -> DataFrame:
    """Hourly roll-up rows with exact sums kept for later merges."""
    agg = events.groupBy(F.date_trunc("hour", "timestamp").alias("bucket_start"),
                         "region", "status", "device_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("temperature").alias("sum_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.sum("voltage").alias("sum_voltage"),
        F.min("voltage").alias("min_voltage"),
        F.max("voltage").alias("max_voltage"),
        F.sum("event_lag_ms").cast("double").alias("sum_event_lag_ms"),
        F.min("timestamp").alias("first_event_at"),
        F.max("timestamp").alias("last_event_at"),
    )
    return agg


def merge(current: DataFrame | None, new: DataFrame) -> DataFrame:
    """Upsert of roll-up rows: counts and sums add, minima/maxima combine.
    Associative and commutative, so batches may arrive in any order."""
    rows = new if current is None else current.unionByName(new)
    return rows.groupBy(*ROLLUP_KEYS).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("sum_temperature").alias("sum_temperature"),
        F.min("min_temperature").alias("min_temperature"),
        F.max("max_temperature").alias("max_temperature"),
        F.sum("sum_voltage").alias("sum_voltage"),
        F.min("min_voltage").alias("min_voltage"),
        F.max("max_voltage").alias("max_voltage"),
        F.sum("sum_event_lag_ms").alias("sum_event_lag_ms"),
        F.min("first_event_at").alias("first_event_at"),
        F.max("last_event_at").alias("last_event_at"),
    )


def exposed(rollups: DataFrame) -> DataFrame:
    """The roll-up table as read by users: means instead of internal sums."""
    n = F.col("event_count")
    return rollups.select(
        *ROLLUP_KEYS, "event_count",
        (F.col("sum_temperature") / n).alias("avg_temperature"), "min_temperature", "max_temperature",
        (F.col("sum_voltage") / n).alias("avg_voltage"), "min_voltage", "max_voltage",
        (F.col("sum_event_lag_ms") / n).alias("avg_event_lag_ms"), "first_event_at", "last_event_at")


@dataclass
class RetentionRun:
    events: DataFrame       # remaining events
    ledger: DataFrame       # remaining ledger rows (cascade)
    rollups: DataFrame      # merged roll-ups (internal sums)
    report: DataFrame       # one row


def run(events: DataFrame, ledger: DataFrame, rollups: DataFrame | None, cutoff: Column,
        batch_size: int | None = None, execute: bool = False, materialize: Materialize = lazy) -> RetentionRun:
    """R5+R6: inspect, select, roll up, delete (anti-join) and report.

    Dry run by default (tables unchanged, report only).  The deleted count
    must equal the selected count; :func:`assert_report` checks it before the
    caller publishes the new versions.  ``materialize`` is called once, on the
    selected rows, which are read four times.
    """
    report = inspect(events, ledger, cutoff).select(
        F.lit("execute" if execute else "dry-run").alias("mode"), cutoff.alias("cutoff"),
        F.lit(batch_size).cast("bigint").alias("batch_size"), "*")
    if not execute:
        return RetentionRun(events, ledger, rollups, report)
    chosen = materialize(select_batch(events, ledger, cutoff, batch_size), "retention-batch")
    batch = chosen.select("event_id")
    new_rollups = rollup(chosen)
    merged = merge(rollups, new_rollups)
    remaining = events.join(batch, "event_id", "left_anti")
    remaining_ledger = ledger.join(batch, "event_id", "left_anti")
    counts = (batch.agg(F.count(F.lit(1)).alias("selected_events"))
              .crossJoin(new_rollups.agg(F.count(F.lit(1)).alias("rollup_rows")))
              .crossJoin(events.agg(F.count(F.lit(1)).alias("_before")))
              .crossJoin(remaining.agg(F.count(F.lit(1)).alias("_after")))
              .select("selected_events", "rollup_rows",
                      (F.col("_before") - F.col("_after")).alias("deleted_events")))
    return RetentionRun(remaining, remaining_ledger, merged, report.crossJoin(counts))


def assert_report(report_row) -> None:
    """Fail the run (publish nothing) when deleted != selected."""
    if report_row["deleted_events"] != report_row["selected_events"]:
        raise RuntimeError(
            f"selected {report_row['selected_events']} events but deleted {report_row['deleted_events']}")


def check_arguments(retention_days: int, batch_size: int | None) -> None:
    if retention_days < 1:
        raise ValueError("retention days must be positive")
    if batch_size is not None and batch_size < 1:
        raise ValueError("batch size must be positive")


def _without(change: Change, store: TableStore, table: str, dates: list, chosen: DataFrame,
             run: int) -> tuple[int, int]:
    """Replace the rows of ``dates`` by those whose id is not chosen; other
    dates' files are neither read nor written.  (rows before, rows after)."""
    rows = change.manifest.read(change.base, table)
    if rows is None:
        return 0, 0
    old = rows.filter(F.col("event_date").isin(dates))
    kept = old.drop("run", "batch_id").join(chosen.select("event_id"), "event_id", "left_anti")
    entry = store.write_batch(kept.select(*[c for c in rows.columns if c not in ("run", "batch_id")]), table, run, 0)
    change.supersede(table, [str(d) for d in dates], entry)
    return old.count(), entry["rows"]


def _forget_readings(change: Change, store: TableStore, chosen: DataFrame, run: int) -> None:
    """A deleted event is no device's newest reading any more: such a device's
    newest is sought among its rows that stay (older ones, so in no later
    date than the deleted one's), and the table is written anew."""
    manifest, base = change.manifest, change.base
    table = store.readings(manifest)
    newest = newest_readings(table.read(base).select("device_id", "_reading"))
    gone = newest.join(chosen.select("event_id"), F.col("_reading.event_id") == F.col("event_id"), "left_semi")
    columns = [f.name for f in newest.schema["_reading"].dataType.fields]
    stay = manifest.read(change.next, "events").join(
        gone.select("device_id", F.col("_reading.timestamp").alias("_upto")), "device_id") \
        .filter((F.col("event_date") <= F.to_date("_upto")) & (F.col("timestamp") <= F.col("_upto")))
    sought = newest_readings(stay.select("device_id", *columns))
    rows = newest.join(gone.select("device_id"), "device_id", "left_anti").unionByName(sought)
    old = change.next.entries(table.table)
    change.replace(table.table, old, [table.write(change, rows, run, 0, max(e["level"] for e in old))])


def run_job(spark: SparkSession, store: TableStore, now: Column, retention_days: int = 30,
            batch_size: int | None = None, execute: bool = False) -> dict:
    """R6 over an ingest store: one pass; the report as a dictionary.

    Dry run by default.  Executing, the pass selects once (written), rolls up
    the selected rows, merges the roll-ups of the hours concerned, removes the
    rows from events, ledger and acknowledgements in the dates concerned, and
    forgets their ids, so that a later delivery of one is a new event.  All of
    it is published as one version, and only if as many events went as were
    selected.  Repeat until ``eligible_events`` is 0 when ``batch_size`` is set.
    """
    check_arguments(retention_days, batch_size)
    manifest = store.manifest(spark)
    base = manifest.version()
    cutoff = now - F.make_interval(days=F.lit(retention_days))
    events, ledger = manifest.read(base, "events"), manifest.read(base, "ledger")
    if events is None:
        return {"mode": "execute" if execute else "dry-run", "eligible_events": 0, "protected_pending_events": 0}
    acks = manifest.read(base, "acks")
    ledger = ledger_with_acks(ledger, acks) if acks is not None else ledger.withColumn(
        "published_at", F.lit(None).cast("timestamp"))
    in_range = F.col("event_date") <= F.to_date(cutoff)                # dates after it are not opened
    old, old_ledger = events.filter(in_range), ledger.filter(in_range)
    report = {"mode": "execute" if execute else "dry-run", "batch_size": batch_size,
              **inspect(old, old_ledger, cutoff).first().asDict()}
    if not execute or not report["eligible_events"]:
        return report

    run = -1 - base.number                       # a folder name no ingest run uses
    work = store.path(f"_work/retention-{base.number}")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    chosen = written(select_batch(old, old_ledger, cutoff, batch_size), "chosen")
    change = Change(manifest, base)
    dates = sorted(r["event_date"] for r in chosen.select("event_date").distinct().collect())   # days, not rows
    selected = chosen.count()
    before, after = _without(change, store, "events", dates, chosen, run)
    _without(change, store, "ledger", dates, chosen, run)
    _without(change, store, "acks", dates, chosen, run)
    store.ids(manifest).rewrite(change, stored_ids(store, manifest, base).join(
        chosen.select("event_id"), "event_id", "left_anti"), run, 0)
    _forget_readings(change, store, chosen, run)
    report |= {"rollup_rows": _add_rollups(change, store, dates, rollup(chosen), run),
               "selected_events": selected, "deleted_events": before - after}
    assert_report(report)
    change.publish(**{k: str(v) if k.endswith("_event") else v for k, v in report.items()})
    delete(spark, work)
    return report


def stored_ids(store: TableStore, manifest: Manifest, version: Version) -> DataFrame:
    return store.ids(manifest).ids.read(version).select("event_id")


def _add_rollups(change: Change, store: TableStore, dates: list, new: DataFrame, run: int) -> int:
    """Merge roll-ups into the stored ones of the same dates; the number of new rows."""
    current = change.manifest.read(change.base, "rollups")
    if current is not None:
        current = current.filter(F.col("event_date").isin(dates)).select(*new.columns)
    merged = merge(current, new).withColumn("event_date", F.to_date("bucket_start"))
    change.know("rollups", merged)
    change.supersede("rollups", [str(d) for d in dates], store.write_batch(merged, "rollups", run, 0))
    return new.count()
