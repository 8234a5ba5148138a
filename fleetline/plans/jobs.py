"""Batch job entry points: ingest runs over log folders into a table root.

A run is one batch of the streaming job's :func:`process_batch`: it stores the
events that no earlier run stored, enriched against what they stored, and
publishes its rows as one version under its own run number.  Tables are
Parquet under ``root`` (a shared folder on a cluster); ``events`` lies by
``event_date`` and is sorted by (device, timestamp) inside each file, so date,
device and time predicates prune.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetline.session import prepare_session
from fleetline.streaming.job import (
    DELIVERY_SCHEMA, TableStore, note_run, next_run, process_batch,
)


def _open_run(spark: SparkSession, store: TableStore, log_path: str) -> int:
    """The number of an unfinished run over the same log, else a new one."""
    runs = store.read(spark, "runs")
    if runs is not None:
        done = runs.filter("state = 'done'").select("run")
        left = runs.filter((F.col("state") == "begun") & (F.col("source") == log_path)) \
            .join(done, "run", "left_anti").agg(F.max("run")).first()[0]
        if left is not None:
            return left
    run = next_run(spark, store)
    note_run(spark, store, log_path, "begun", run)
    return run


def run_ingest(spark: SparkSession, log_path: str, root: str,
               processing_time: Callable[[DataFrame], Column] | None = None) -> TableStore:
    """Ingest every delivery file under ``log_path`` into the tables at ``root``.

    A run that failed is repeated under its number by calling this again with
    the same log.
    """
    prepare_session(spark)
    store = TableStore(root)
    run = _open_run(spark, store, log_path)
    process_batch(spark.read.schema(DELIVERY_SCHEMA).parquet(log_path), 0, store, processing_time, run)
    note_run(spark, store, log_path, "done", run)
    return store
