"""Adapter from the driver's ``events`` table to a raw delivery log.

The driver's ``events`` table (event_id, ts, user_id, event_type, value,
props) is clean.  The adapter turns it, by integer arithmetic only, into the
log a telemetry fleet would produce: JSON envelopes keyed by device, spread
over three source partitions, with late arrivals, re-deliveries, missing
fields, malformed bytes, arrays, unknown schema versions and out-of-range
readings.  The same rules are written in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetline.constants import RAW_TOPIC
from fleetline.operators.sequence import dense_sequence

# --- fixed values: fixture rules ---------------------------------------------
BASE_US = 1704067200000000            # 2024-01-01T00:00:00Z
TIME_SQUEEZE = 120                     # 30 days squeezed into 6 hours
NOW_US = BASE_US + 6 * 3600 * 1000000  # fixed "now" of the read queries
CUTOFF_US = BASE_US + 3 * 3600 * 1000000   # fixed retention cutoff
SOURCE_PARTITIONS = 3
REGIONS = ("us-east", "us-west", "eu-central", "ap-south")
ON_TIME_DELAY_US = 200000
REDELIVERY_DELAY_US = 60000000
LEDGER_ACK_DELAY_US = 1000000
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
OFFSET_CHUNK_US = 600 * 1000000        # chunk width for parallel offset numbering


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(us: Column) -> Column:
    return F.date_format(F.timestamp_micros(us), TS_FORMAT)


def fixture_events(events: DataFrame) -> DataFrame:
    """One row per source event with every derived field of the fixture."""
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    t_us = F.lit(BASE_US) + F.expr(
        f"(unix_micros(cast(ts as timestamp)) - {BASE_US}) div {TIME_SQUEEZE}")
    late = (F.lit(30) + (eid * 7919) % 571) * 1000000
    region_ix = (F.col("user_id") + F.when(eid % 97 == 0, 1).otherwise(0)) % 4
    region = F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (region_ix + 1).cast("int"))
    return events.select(
        eid.alias("eid"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        k.alias("k"),
        t_us.alias("t_us"),
        eid.cast("string").alias("event_id"),
        F.concat(F.lit("sensor-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("device_id"),
        (t_us + F.when(eid % 20 == 0, late).otherwise(ON_TIME_DELAY_US)).alias("recv_us"),
        F.when(F.col("event_type") == "error",
               F.when(k % 2 == 0, "FAILED").otherwise("WARNING")).otherwise("OK").alias("status"),
        F.round(F.col("value") - F.lit(45.0), 2).alias("temperature"),
        ((F.lit(960) + k * 5) / F.lit(100.0)).alias("voltage"),
        region.alias("region"),
    )


def _envelope_json(d: DataFrame) -> Column:
    eid = F.col("eid")
    missing = F.when(eid % 200 == 3, F.expr("(eid div 200) % 3"))
    event = F.struct(
        F.col("event_id"),
        F.when(missing.isNull() | (missing != 0), F.col("device_id")).alias("device_id"),
        F.when(missing.isNull() | (missing != 1), _iso(F.col("t_us"))).alias("timestamp"),
        F.when(missing.isNull() | (missing != 2), F.col("temperature")).alias("temperature"),
        F.col("voltage"),
        F.col("status"),
        F.col("region"),
    )
    v0 = eid % 10 == 0
    envelope = F.struct(
        F.when(~v0, F.when(eid % 500 == 13, F.lit(999)).otherwise(F.lit(1))).alias("schema_version"),
        F.when(~v0, F.lit(1)).alias("schema_id"),
        event.alias("event"),
        _iso(F.col("recv_us")).alias("received_at"),
    )
    body = F.to_json(envelope)
    return (F.when(eid % 500 == 11, F.lit("{not-json"))
            .when(eid % 500 == 17, F.concat(F.lit("["), body, F.lit("]")))
            .otherwise(body))


def deliveries(events: DataFrame) -> DataFrame:
    """The raw log: ``key, value, topic, partition, offset, timestamp``.

    ``timestamp`` is the log append time (arrival); offsets are dense per
    source partition in arrival order, like a broker assigns them.
    """
    # Numbered first: only the narrow source columns are shuffled, and the JSON
    # is built by the numbered chunks' tasks, however few splits the table has.
    attempts = F.when(F.col("eid") % 50 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    log = fixture_events(events).withColumn("attempt", F.explode(attempts)) \
        .withColumn("arr_us", F.col("recv_us") + F.col("attempt") * REDELIVERY_DELAY_US) \
        .withColumn("partition", (F.col("user_id") % SOURCE_PARTITIONS).cast("int"))
    log = dense_sequence(log, ["partition"], ["arr_us", "eid", "attempt"],
                         chunk=F.expr(f"arr_us div {OFFSET_CHUNK_US}"), out="offset")
    log = log.select(F.col("device_id").cast("binary").alias("key"), _envelope_json(log).cast("binary").alias("value"),
                     F.lit(RAW_TOPIC).alias("topic"), "partition", "offset", "arr_us")
    return log.select("key", "value", "topic", "partition", "offset",
                      F.timestamp_micros("arr_us").alias("timestamp"))


def fixture_processing_time(df: DataFrame) -> Column:
    """Deterministic processing instant of the fixture (0.05 s to 6.8 s after
    arrival); 0.05 s when the message carries no readable event id."""
    eid = F.col("event_id").try_cast("bigint")
    return F.timestamp_micros(F.unix_micros(F.col("arrival_ts")) + F.lit(50000)
                              + F.coalesce((eid % 97) * 70000, F.lit(0)))


def fixture_acks(ledger: DataFrame) -> DataFrame:
    """Acknowledgements of the ledger dispatcher: every row but ``eid % 7 = 0``,
    one second after processing."""
    eid = F.col("event_id").cast("bigint")
    return (ledger.filter(eid % 7 != 0)
            .select("event_id",
                    F.timestamp_micros(F.unix_micros("created_at") + LEDGER_ACK_DELAY_US)
                    .alias("published_at")))


@dataclass(frozen=True)
class FixtureParams:
    now_us: int = NOW_US
    cutoff_us: int = CUTOFF_US

    @property
    def now(self) -> Column:
        return F.timestamp_micros(F.lit(self.now_us))

    @property
    def cutoff(self) -> Column:
        return F.timestamp_micros(F.lit(self.cutoff_us))


# --- fixed values: fixture samples (minutes after the fixture's start) -------
NOT_READY_MINUTES = (60, 63)          # no worker is ready; a restart follows minute 60
ABSENT_MINUTES = (120, 124)           # no worker is scraped
CACHE_DOWN_MINUTES = (180, 184)       # the cache dependency is not ready
STALL_MINUTES = (241, 250)            # deliveries appended then are processed after minute 251
DEPENDENCIES = ("log", "store", "cache")
LAG_THRESHOLD = 100.0                 # fits the fixture's rate at sf0.01


def _minute(ts: Column) -> Column:
    """Minutes after the fixture's start, of the minute that ends at or after ``ts``."""
    return F.ceil((F.unix_micros(ts) - F.lit(BASE_US)) / 60000000)


def readiness_samples(routed: DataFrame) -> DataFrame:
    """(metric, ts, value): a scrape per source partition and minute with a
    delivery.  Partition p is worker p, and stands for dependency p too."""
    seen = routed.select(_minute(F.col("arrival_ts")).alias("m"), F.col("source_partition").alias("p")).distinct()
    ts = F.timestamp_micros(F.lit(BASE_US) + F.col("m") * 60000000)
    worker = seen.filter(~F.col("m").between(*ABSENT_MINUTES)).select(
        F.lit("worker_ready").alias("metric"), ts.alias("ts"),
        F.when(F.col("m").between(*NOT_READY_MINUTES), 0.0).otherwise(1.0).alias("value"))
    down = (F.col("p") == DEPENDENCIES.index("cache")) & F.col("m").between(*CACHE_DOWN_MINUTES)
    return worker.unionByName(seen.select(F.lit("dependency_ready").alias("metric"), ts.alias("ts"),
                                          F.when(down, 0.0).otherwise(1.0).alias("value")))


def stalled(routed: DataFrame) -> DataFrame:
    """Deliveries with a consumer that stood still for ten minutes."""
    end = F.timestamp_micros(F.lit(BASE_US + (STALL_MINUTES[1] + 1) * 60000000 + 1))
    return routed.withColumn("processed_at", F.when(
        _minute(F.col("arrival_ts")).between(*STALL_MINUTES), F.greatest("processed_at", end))
        .otherwise(F.col("processed_at")))
