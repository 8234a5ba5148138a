"""Skew-safe ordered operators equal their single-window forms; batch job entry."""

import os
import random
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetline.operators.sequence import dense_sequence, running_max_before, top_k_per_group
from fleetline.plans.jobs import run_ingest
from fleetline.sources import fixture
from tests.conftest import SF_SMALL


def _frame(spark):
    rnd = random.Random(7)
    # key "hot" holds most rows; many ties in t
    rows = [(("hot" if rnd.random() < 0.7 else f"k{rnd.randint(0, 5)}"), rnd.randint(0, 5000), i,
             rnd.uniform(0, 100)) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, t long, i long, v double")


def test_dense_sequence_equals_row_number(spark):
    df = _frame(spark)
    got = dense_sequence(df, ["k"], ["t", "i"], chunk=F.expr("t div 250"), out="n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "i")) - 1)
    assert sorted(got.select("i", "n").collect()) == sorted(want.select("i", "n").collect())


def test_running_max_before_equals_window(spark):
    df = _frame(spark)
    value = F.struct("v", "i")
    got = running_max_before(df, ["k"], ["t", "i"], chunk=F.expr("t div 300"), value=value, out="m")
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("m", F.max(value).over(w))
    assert sorted(got.select("i", "m").collect()) == sorted(want.select("i", "m").collect())


def test_top_k_equals_single_pass(spark):
    df = _frame(spark)
    order = [F.col("v").desc(), F.col("i").desc()]
    got = top_k_per_group(df, ["k"], order, 7, salt=F.col("i") % 4)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order))).filter("rank <= 7")
    assert sorted(got.select("i", "rank").collect()) == sorted(want.select("i", "rank").collect())


def test_batch_job_writes_partitioned_tables(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    log_dir = os.path.join(root, "log")
    fixture.deliveries(fixture.read_table(spark, SF_SMALL, "events")).write.parquet(log_dir)
    run_ingest(spark, log_dir, os.path.join(root, "tables"), fixture.fixture_processing_time)
    events = spark.read.parquet(os.path.join(root, "tables", "events"))
    assert events.count() == 988                       # FIXTURES.md: stored events at sf0.001
    assert "event_date" in events.columns
    assert spark.read.parquet(os.path.join(root, "tables", "device_status")).count() == 15
    assert spark.read.parquet(os.path.join(root, "tables", "dead_letters")).count() == 1020 - 1008


def test_interval_minimum_covers_with_few_ranges(spark):
    from fleetline.plans import slo
    rnd = random.Random(9)
    spans = [(rnd.randint(0, 3000), rnd.randint(0, 3000), i) for i in range(60)] + [(0, 1 << slo.LEVELS, 99), (5, 5, -1)]
    intervals = spark.createDataFrame(spans, "lo long, hi long, v int")
    points = spark.range(3000).select(F.col("id").alias("m"))
    got = {r["m"]: r["_min"] for r in slo.interval_minimum(intervals, "lo", "hi", "v", points, "m").collect()}
    assert got == {m: min((v for lo, hi, v in spans if lo <= m < hi), default=None) for m in range(3000)}
    day = spark.createDataFrame([(28_000_001, 28_001_441)], "lo long, hi long")
    ranges = day.select(F.explode(slo.dyadic_cover(F.col("lo"), F.col("hi"))).alias("n")).select("n.*").collect()
    assert len(ranges) <= 22 and sum(2 ** r["level"] for r in ranges) == 1440


def test_rules_and_counter_resets(spark):
    from fleetline.plans import slo
    grid = spark.createDataFrame([(m,) for m in range(6)], "m int").select(
        F.timestamp_micros(F.col("m") * F.lit(60_000_000).cast("long")).alias("ts"))
    values = [("up", 0, 1.0), ("up", 0, 0.0), ("up", 1, 0.0), ("up", 4, 0.0), ("up", 5, 1.0), ("lag", 2, 60.0), ("lag", 2, 50.0)]
    samples = spark.createDataFrame(values, "metric string, m int, value double").select(
        "metric", F.timestamp_micros(F.col("m") * F.lit(60_000_000).cast("long")).alias("ts"), "value")
    rules = [("Down", "up", "max", "<", 1.0, 120), ("Lag", "lag", "sum", ">", 100.0, 60), ("Part", "up", "min", "<", 1.0, 60)]
    rows = slo.evaluate_rules(samples, grid, rules, ["Down"]).orderBy("alert", "ts").collect()
    states = {a: [r["state"] for r in rows if r["alert"] == a] for a in ("Down", "Lag", "Part")}
    assert states == {"Down": ["inactive", "pending", "pending", "firing", "firing", "inactive"],
                      "Lag": ["inactive", "inactive", "pending", "inactive", "inactive", "inactive"],
                      "Part": ["pending", "firing", "inactive", "inactive", "pending", "inactive"]}
    counter = spark.createDataFrame([(m, float(v)) for m, v in enumerate((2, 5, 5, 1, 4, 4))], "m int, value double").select(
        F.lit("w").alias("worker"), F.timestamp_micros(F.col("m") * F.lit(60_000_000).cast("long")).alias("ts"), "value")
    steps = [r["increase"] for r in slo.counter_increase(counter, ["worker"], 2).orderBy("ts").collect()]
    assert steps == [2.0, 5.0, 3.0, 1.0, 4.0, 3.0]
