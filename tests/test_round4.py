"""Fixes of the third round's findings."""

import tempfile

from pyspark.sql import functions as F

from fleetline.llm import mixing
from fleetline.plans import registry
from fleetline.plans.catalog import FixtureCatalog
from fleetline.plans.pipeline import ingest
from fleetline.sources import fixture
from fleetline.streaming import recent
from tests.helpers import deliveries, envelope, event, fixed_processing
from tests.test_recent_stream import add_file


def source_events(spark, n=300):
    return spark.range(n).select(
        F.col("id").alias("event_id"), (F.timestamp_micros(F.lit(fixture.BASE_US) + F.col("id") * 7_000_000)
                                        ).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.when(F.col("id") % 9 == 0, "error").otherwise("view").alias("event_type"),
        (F.col("id") % 50 + 40.25).alias("value"), F.concat(F.lit('{"k":'), F.col("id") % 90, F.lit("}")).alias("props"))


def small_catalog(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    source_events(spark).write.parquet(f"{root}/events.parquet")
    return FixtureCatalog(spark, root)


def test_deliveries_are_numbered_before_their_json_is_built(spark):
    log = fixture.deliveries(source_events(spark))
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert "not-json" in plan and plan.rindex("not-json") < plan.index("Window")
    assert log.count() == 300 + 6                                # ids 7, 57, ... come twice


def test_outcomes_need_no_enrichment(spark):
    written = []

    def note(df, name):
        written.append(name)
        return df
    log = deliveries(spark, [envelope(event("a")), b"{bad", b"[1]", envelope(event("b", region=...))])
    result = ingest(log, fixed_processing(), materialize=note)
    assert result.routed.filter("reason is null").count() == 1
    assert result.dead_letters.count() == 3 and written == ["routed"]
    assert result.events.count() == 1 and written == ["routed", "stored", "events"]


def test_metrics_read_the_stored_rows(spark):
    c = small_catalog(spark)
    for query in (registry.latency_quantile, registry.alert_states, registry.alert_rules):
        assert query(c).count() > 0
    assert "events" not in vars(c.ingest)
    times = ["event_id", "created_at", "published_at"]
    assert sorted(map(str, c.ledger_times.select(times).collect())) == sorted(map(str, c.ledger.select(times).collect()))


def test_ids_of_the_recent_stream_are_aggregated(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        add_file(spark, f"{root}/log", 1, [envelope(event("a", device="one", temperature=1.0))])
        query = recent.start(spark, f"{root}/log", recent.RecentStore(f"{root}/t", 2), f"{root}/ckpt",
                             max_per_trigger=1, processing_time=fixed_processing(), interval="0 seconds")
        try:
            query.ids.processAllAvailable()
            add_file(spark, f"{root}/log", 0, [envelope(event("a", device="two", temperature=2.0))])
        finally:
            recent.run_until_idle(query, 200)                    # a smaller offset in a later batch
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    operators = [o.operatorName for p in query.ids.recentProgress for o in p.stateOperators]
    assert operators and set(operators) == {"stateStoreSave"}
    rows = recent.RecentStore(f"{root}/t", 2).read(spark).collect()
    assert [(r["device_id"], r["temperature"]) for r in rows] == [("one", 1.0)]


def test_the_training_order_places_every_copy(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(["w"] * (i % 5)), "ab"[i % 2]) for i in range(40)], "doc_id long, text string, source string")
    stream = mixing.training_order(docs).cache()
    placed = [r["position"] for r in stream.collect() if r["position"] is not None]
    assert len(placed) == sum(r["copies"] for r in mixing.mix(docs).collect()) and placed == sorted(placed)
    got = mixing.folded(stream)
    assert got.filter("size(positions) > 1 and positions[0] < positions[1]").count() > 0
    same = ["doc_id", "size", "source_size", "target", "taken", "position"]
    assert got.select(same).exceptAll(mixing.mix(docs).select(same)).count() == 0 and got.count() == 40
