"""The ingest job: deliveries -> routed -> stored + enriched -> state tables.

``ingest`` is pure DataFrame composition; the batch job and the streaming
``foreachBatch`` both call it.  ``store`` is given for incremental runs:
events already stored are not stored again (first wins over the whole
history), and their history feeds the enrichment of the new events.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.operators import enrich as E
from fleetline.operators import route as R
from fleetline.operators import state as S


Materialize = Callable[[DataFrame, str], DataFrame]


class IngestResult:
    """The tables of one ingest run, each built when it is first asked for: a
    query of outcomes does not pay for the enrichment of the stored events."""

    def __init__(self, deliveries: DataFrame, processing_time: Callable[[DataFrame], Column] | None,
                 batch_id: int, materialize: Materialize):
        self._deliveries, self._processing_time = deliveries, processing_time
        self._batch_id, self._materialize = batch_id, materialize

    @cached_property
    def routed(self) -> DataFrame:
        """Every delivery with its outcome."""
        return self._materialize(R.route(self._deliveries, self._processing_time), "routed")

    @cached_property
    def valid(self) -> DataFrame:
        """Valid deliveries (duplicates included)."""
        return R.valid_deliveries(self.routed)

    @cached_property
    def stored(self) -> DataFrame:
        """First delivery per id, not enriched."""
        return self._materialize(E.first_arrivals(self.valid), "stored")

    @cached_property
    def events(self) -> DataFrame:
        """The stored events, enriched: a row for each row of ``stored``."""
        return self._materialize(
            E.enrich(self.stored).withColumn("batch_id", F.lit(self._batch_id).cast("bigint"))
            .withColumn("event_date", F.to_date("timestamp")), "events")

    @cached_property
    def dead_letters(self) -> DataFrame:
        """One row per failed delivery coordinate."""
        return dead_letter_rows(R.failed_deliveries(self.routed))

    @cached_property
    def device_status(self) -> DataFrame:
        return S.device_status(self.events)

    @cached_property
    def ledger(self) -> DataFrame:
        return S.ledger_rows(self.events)


def dead_letter_rows(failed: DataFrame) -> DataFrame:
    """Dead-letter table rows keyed by source coordinates.

    A re-processed coordinate keeps its first payload and creation time and
    takes the latest reason (``ON CONFLICT ... SET reason``).
    """
    attempt = F.struct("processed_at", "arrival_ts")
    return failed.groupBy("source_topic", "source_partition", "source_offset").agg(
        F.min_by("payload", attempt).alias("payload"),
        F.max_by("reason", attempt).alias("reason"),
        F.min("processed_at").alias("created_at"),
        F.min("arrival_ts").alias("arrival_ts"),
    )


def lazy(df: DataFrame, _name: str) -> DataFrame:
    return df


def ingest(deliveries: DataFrame, processing_time: Callable[[DataFrame], Column] | None = None,
           batch_id: int = 0, materialize: Materialize = lazy) -> IngestResult:
    """One ingest run.  ``materialize(df, name)`` is called on the frames that
    are read more than once (``routed``, ``stored``, ``events``): a job passes
    a writer to its table folder (or ``checkpoint``), a micro-batch ``persist``."""
    return IngestResult(deliveries, processing_time, batch_id, materialize)


def incremental_store(valid_batch: DataFrame, store: DataFrame | None, batch_id: int) -> DataFrame:
    """Insert-if-absent: first arrivals of the batch whose id is not stored yet
    (``left_anti``, not ``NOT IN``), appended under ``batch_id``."""
    first = E.first_arrivals(valid_batch)
    if store is not None:
        first = first.join(store.select("event_id"), "event_id", "left_anti")
    first = first.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    return first if store is None else store.unionByName(first)
