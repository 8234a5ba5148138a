"""Batch = stream, and a replayed micro-batch changes nothing."""

import os
import tempfile

from pyspark.sql import functions as F

from fleetline.operators.enrich import EVENT_COLUMNS
from fleetline.plans.catalog import present
from fleetline.plans.pipeline import ingest
from fleetline.sources import fixture
from fleetline.streaming import job
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in present(df.select(*EVENT_COLUMNS)).collect())


def test_stream_in_three_batches_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    log = fixture.deliveries(fixture.read_table(spark, SF_SMALL, "events"))
    log = spark.createDataFrame(log.collect(), log.schema)      # small fixture: freeze it
    bounds = log.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).collect()[0]
    span = (bounds["hi"] - bounds["lo"]) / 3
    src = os.path.join(root, "source")
    os.makedirs(src)
    for i in range(3):
        lo, hi = bounds["lo"] + span * i, bounds["lo"] + span * (i + 1)
        part = log.filter((F.col("timestamp") >= lo) & ((F.col("timestamp") < hi) if i < 2 else F.lit(True)))
        tmp = os.path.join(root, f"split{i}")
        part.coalesce(1).write.parquet(tmp)
        name = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        os.rename(os.path.join(tmp, name), os.path.join(src, f"b{i}.parquet"))
    store = job.TableStore(os.path.join(root, "tables"))
    q = job.start(spark, src, store, os.path.join(root, "ckpt"), max_per_trigger=1,
                  processing_time=fixture.fixture_processing_time)
    q.awaitTermination(600)
    streamed = store.read(spark, "events")
    assert streamed.select("batch_id").distinct().count() == 3
    expected = ingest(log, fixture.fixture_processing_time).events
    assert _rows(streamed) == _rows(expected)

    # replay of batch 1 (a rewound micro-batch): the tables do not change
    before = _rows(store.read(spark, "events"))
    dead_before = store.read(spark, "dead_letters").count()
    batch1 = spark.read.parquet(os.path.join(src, "b1.parquet"))
    job.process_batch(batch1, 1, store, fixture.fixture_processing_time)
    assert _rows(store.read(spark, "events")) == before
    assert store.read(spark, "dead_letters").count() == dead_before
    status = store.status(spark)
    exp_status = ingest(log, fixture.fixture_processing_time).device_status.drop("_winner")
    assert sorted(map(tuple, present(status).collect())) == sorted(map(tuple, present(exp_status).collect()))
