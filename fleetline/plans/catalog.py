"""Tables of one data directory, built once per session and reused.

The registered queries all start from the driver's parquet tables; the
ingest job runs once per (session, directory) and its outputs are persisted
(MEMORY_AND_DISK: recomputed from lineage if an executor is lost) so that
many queries over the same directory do not repeat it.
"""

from __future__ import annotations

import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetline.operators import state as S
from fleetline.plans.pipeline import IngestResult, ingest
from fleetline.session import checkpoint_dir, prepare_session
from fleetline.sources import fixture

_LOCK = threading.Lock()
_CATALOGS: dict[tuple[str, str], "FixtureCatalog"] = {}


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the session's checkpoint folder
    and read it back: cuts the lineage (small plans, no recomputation after an
    executor loss) and keeps column pruning and filter pushdown."""
    spark = df.sparkSession
    root = checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class FixtureCatalog:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare_session(spark)
        self.sf_dir = sf_dir
        self.params = fixture.FixtureParams()

    def table(self, name: str) -> DataFrame:
        return fixture.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def deliveries(self) -> DataFrame:
        return write_table(fixture.deliveries(self.table("events")), "deliveries")

    @cached_property
    def ingest(self) -> IngestResult:
        return ingest(self.deliveries, fixture.fixture_processing_time, materialize=write_table)

    @property
    def events(self) -> DataFrame:
        return self.ingest.events

    @property
    def stored(self) -> DataFrame:
        """The stored events without their enrichment: same rows, for queries
        that read no enriched column."""
        return self.ingest.stored

    @property
    def status(self) -> DataFrame:
        return self.ingest.device_status

    @property
    def dead_letters(self) -> DataFrame:
        return self.ingest.dead_letters

    @cached_property
    def replays(self) -> DataFrame:
        from fleetline.plans.deadletter import fixture_replays
        return fixture_replays(self.dead_letters, self.params.now)

    @cached_property
    def edge_checked(self) -> DataFrame:
        """Edge bodies with their validation result, written once (the
        UUID fill-in of missing ids must not change between readers)."""
        from fleetline.plans.edge import check_elements, edge_elements
        return write_table(check_elements(edge_elements(self.table("events"))), "edge_checked")

    @cached_property
    def acks(self) -> DataFrame:
        return fixture.fixture_acks(self.ingest.ledger)

    @property
    def ledger(self) -> DataFrame:
        """Ledger with ``published_at`` (NULL = pending)."""
        return S.ledger_with_acks(self.ingest.ledger, self.acks)

    @property
    def ledger_times(self) -> DataFrame:
        """The ledger's (event_id, created_at, published_at): the same rows,
        without the payload and so without the enrichment it is made of."""
        times = S.ledger_times(self.stored)
        return S.ledger_with_acks(times, fixture.fixture_acks(times))


def catalog(spark: SparkSession, sf_dir: str) -> FixtureCatalog:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        found = _CATALOGS.get(key)
        if found is None:
            found = _CATALOGS[key] = FixtureCatalog(spark, sf_dir)
        return found


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparison-friendly projection: timestamps as epoch microseconds
    (zone-free), doubles rounded to ``digits``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits) + F.lit(0.0)    # -0.0 -> 0.0
        cols.append(c.alias(f.name))
    return df.select(*cols)
