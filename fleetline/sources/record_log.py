"""A record log in files, as a Python data source (sinks S6, S7, L6).

``df.write.format("record_log")`` appends records (``key``, ``value``,
``headers``, ``timestamp`` and an ``ack_id``) to the log at ``path``.  Every
task writes one file and reports it in its commit message; the driver's commit
then lists the files of all tasks in the log's next commit file, in one step.
Readers (:func:`read`) see listed files only, so a failed or repeated task
leaves nothing behind, and what was listed is what the log has acknowledged
(:func:`acknowledged`).

A record's partition is the task's, so callers deal records by key
(:func:`append`); its offset continues the partition's.  A Kafka topic takes
the same columns through ``format("kafka")``; its acknowledgement is the return
of the write.  Files are written through Arrow's file systems, so ``path`` may
be any folder that they and Spark reach under one name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from fleetline.tables.manifest import Files

COMMITS, PARTS = "_commits", "parts"
RECORD_SCHEMA = ("key binary, value binary, headers array<struct<key: string, value: binary>>, "
                 "timestamp timestamp, ack_id string")
LOG_SCHEMA = f"{RECORD_SCHEMA}, topic string, partition int, offset bigint"


@dataclass
class Written(WriterCommitMessage):
    """A task's file: its partition and how many records it holds."""
    file: str
    partition: int
    records: int


def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


class RecordLogWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.topic = options["path"].rstrip("/"), options["topic"]
        self.sequence, self.starts = int(options["sequence"]), json.loads(options["starts"])

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        partition = TaskContext.get().partitionId()
        offset = first = self.starts[partition]
        filesystem, root = _filesystem(self.path)
        name = f"{PARTS}/{uuid.uuid4().hex}.parquet"
        filesystem.create_dir(f"{root}/{PARTS}")
        writer = sink = None
        for batch in iterator:
            n = batch.num_rows
            table = pa.Table.from_batches([batch])
            table = table.append_column("topic", pa.array([self.topic] * n, pa.string()))
            table = table.append_column("partition", pa.array([partition] * n, pa.int32()))
            table = table.append_column("offset", pa.array(range(offset, offset + n), pa.int64()))
            if writer is None:
                sink = filesystem.open_output_stream(f"{root}/{name}")
                writer = pq.ParquetWriter(sink, table.schema)
            writer.write_table(table)
            offset += n
        if writer is None:
            return Written("", partition, 0)
        writer.close()
        sink.close()
        return Written(name, partition, offset - first)

    def commit(self, messages: list) -> None:
        ends = list(self.starts)
        for m in messages:
            ends[m.partition] += m.records
        body = {"files": [m.file for m in messages if m.records], "ends": ends}
        filesystem, root = _filesystem(self.path)
        filesystem.create_dir(f"{root}/{COMMITS}")
        beside = f"{root}/{COMMITS}/{uuid.uuid4().hex}.tmp"
        with filesystem.open_output_stream(beside) as out:
            out.write(json.dumps(body).encode())
        filesystem.move(beside, f"{root}/{COMMITS}/{self.sequence:012d}.json")

    def abort(self, messages: list) -> None:
        filesystem, root = _filesystem(self.path)
        for m in messages:
            if m is not None and m.records:
                filesystem.delete_file(f"{root}/{m.file}")


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def writer(self, schema, overwrite: bool) -> RecordLogWriter:
        return RecordLogWriter(dict(self.options))


def commits(spark: SparkSession, path: str) -> list[dict]:
    files = Files(spark, path)
    return [json.loads(files.text(f"{COMMITS}/{n}")) for n in files.names(COMMITS) if n.endswith(".json")]


def append(spark: SparkSession, records: DataFrame, path: str, topic: str, partitions: int = 3) -> int:
    """Append records in key order of arrival; returns the commit's number.
    One writer appends to a log at a time."""
    spark.dataSource.register(RecordLog)
    made = commits(spark, path)
    starts = made[-1]["ends"] if made else [0] * partitions
    dealt = records.select("key", "value", "headers", "timestamp", "ack_id").repartition(
        len(starts), F.coalesce("key", F.col("ack_id").cast("binary"))).sortWithinPartitions("timestamp", "ack_id")
    (dealt.write.format("record_log").mode("append").option("path", path).option("topic", topic)
     .option("sequence", str(len(made))).option("starts", json.dumps(starts)).save())
    return len(made)


def read(spark: SparkSession, path: str, commit: int | None = None) -> DataFrame:
    """The committed records (of one commit, if given) with topic, partition
    and offset: the columns of the raw log and headers."""
    made = commits(spark, path)
    chosen = made if commit is None else made[commit:commit + 1]
    files = [f"{path.rstrip('/')}/{f}" for c in chosen for f in c["files"]]
    return spark.read.schema(LOG_SCHEMA).parquet(*files) if files else spark.createDataFrame([], LOG_SCHEMA)


def acknowledged(spark: SparkSession, path: str, commit: int) -> DataFrame:
    """(ack_id) of the records that a commit has listed."""
    return read(spark, path, commit).select("ack_id").distinct()
