"""Helpers shared by the training-data operators.

* ``table`` reads a table of a data directory through Spark's reader.
* ``materialize`` cuts lineage with a Parquet table under the shared
  ``spark.checkpoint.dir`` and frees the shuffle files of that write.
* ``attach`` joins a per-key table to rows whose keys may be hot.
* ``packed``/``unpacked`` keep a caller's columns under a prefix, so working
  columns never clash with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetline.session import checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD_SEPARATORS = r"[\x20\x09-\x0D]+"
#: Tables of at most this many rows are broadcast; larger ones join salted.
BROADCAST_ROWS = 50_000
#: Lists that the paths of new scratch tables are noted in.
_NOTED: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The written table survives the loss of any executor.  Shuffle files of
    the write are dropped when it ends, since nothing can read them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    for paths in _NOTED:
        paths.append(path)
    return out


@contextmanager
def noting(paths: list[str]):
    """Note the scratch tables that are made inside the block."""
    _NOTED.append(paths)
    try:
        yield
    finally:
        _NOTED.remove(paths)


def release(docs: DataFrame, paths: list[str]) -> None:
    """Delete noted scratch tables, but for those that ``docs`` reads."""
    used = docs.inputFiles()
    kept = [path for path in paths if any(f"/{path.rsplit('/', 1)[-1]}/" in file for file in used)]
    for path in set(paths).difference(kept):
        _delete(docs.sparkSession, path)
    paths[:] = kept


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete the table behind a frame that ``materialize`` returned."""
    path = getattr(df, "_scratch", None)
    if path:
        _delete(df.sparkSession, path)


def packed(df: DataFrame) -> DataFrame:
    """Every column of ``df`` renamed to ``in_<name>``: working columns cannot
    clash with them, and those not asked for are still pruned."""
    return df.toDF(*[f"in_{c}" for c in df.columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unpacked(columns: Sequence[str], new: Sequence[str]) -> list[Column]:
    """The caller's columns out of a packed frame without those named in
    ``new`` (compared without case, as Spark resolves names), then these."""
    taken = {n.lower() for n in new}
    return ([F.col(quoted(f"in_{c}")).alias(c) for c in columns if c.lower() not in taken]
            + [F.col(n) for n in new])


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows: whole texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def slices(texts, chars: int = 4_000_000):
    """Neighbouring texts in lists of about ``chars`` characters (one longer
    text is a list of its own), so that a batch's words fit in memory."""
    part, size = [], 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        if part and size + len(text) > chars:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; an empty array for null."""
    return F.coalesce(F.array_remove(F.split(text, WORD_SEPARATORS), ""),
                      F.array().cast("array<string>"))


def attach(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], salt: Column,
           how: str = "left", broadcast_rows: int = BROADCAST_ROWS, salts: int = 32) -> DataFrame:
    """Join a materialised table with one row per key to ``rows`` (null keys
    match null keys; ``keys`` appear once in the result).

    The table is counted first.  Up to ``broadcast_rows`` it is broadcast;
    beyond, it is copied once per salt and joined on (keys, salt), so a hot
    key is spread over ``salts`` tasks.  Both forms give the same rows.
    """
    right = per_key.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    if per_key.limit(broadcast_rows + 1).count() <= broadcast_rows:
        left, right, extra = rows, F.broadcast(right), []
    else:
        left = rows.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
        right = right.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        extra = [F.col("_salt") == F.col("_salt_r")]
    on = [F.col(quoted(k)).eqNullSafe(F.col(quoted(f"_k_{k}"))) for k in keys] + extra
    return left.join(right, on, how).drop("_salt", "_salt_r", *[f"_k_{k}" for k in keys])
