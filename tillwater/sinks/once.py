"""Append that a retry cannot repeat: files that nobody sees until their batch is committed.

A writer for tables outside Spark's own file sink, for readers that are told which files
count. Each task writes one parquet file under a name of its own. A batch counts when one
small file that names its data files has been moved into place. A task or a batch
that is tried again writes other files; those of failed tries are never named.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceStreamArrowWriter, WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tillwater.sinks.tables import visible

_COMMITS = "_commits"


@dataclass
class Written(WriterCommitMessage):
    """What a task left: its file, or None if it had no row."""

    file: str | None
    rows: int


class OnceWriter(DataSourceStreamArrowWriter):
    """`run` tells queries that number their batches alike apart."""

    def __init__(self, path: str, run: str):
        self.path, self.run = path, run

    def _store(self) -> tuple[fs.FileSystem, str]:
        # Taken anew wherever the writer is sent: connections do not travel.
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = self._store()
        name, rows, writer = f"part-{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if writer is None:
                store.create_dir(f"{root}/data", recursive=True)
                writer = pq.ParquetWriter(
                    f"{root}/data/{name}", batch.schema, filesystem=store)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return Written(None, 0)
        writer.close()
        return Written(name, rows)

    def commit(self, messages: list, batchId: int) -> None:
        store, root = self._store()
        store.create_dir(f"{root}/{_COMMITS}", recursive=True)
        target = f"{root}/{_COMMITS}/{self.run}-{batchId}.json"
        if store.get_file_info(target).type != fs.FileType.NotFound:
            # Committed here, but Spark did not come to note it: the first try's rows count.
            self.abort(messages, batchId)
            return
        files = sorted(m.file for m in messages if m and m.file)
        draft = f"{root}/{_COMMITS}/.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps({
                "run": self.run, "batch": batchId, "files": files,
                "rows": sum(m.rows for m in messages if m)}).encode())
        store.move(draft, target)

    def abort(self, messages: list, batchId: int) -> None:
        store, root = self._store()
        for message in messages:
            if message and message.file:
                store.delete_file(f"{root}/data/{message.file}")


class OnceSource(DataSource):
    """`df.writeStream.format("tillwater_once").option("path", ...)`."""

    @classmethod
    def name(cls) -> str:
        return "tillwater_once"

    def streamWriter(self, schema: StructType, overwrite: bool) -> OnceWriter:
        run = hashlib.sha256(self.options["checkpointLocation"].encode()).hexdigest()[:16]
        return OnceWriter(self.options["path"], run)


def once_sink(df: DataFrame, path: str) -> DataStreamWriter:
    """Append to a table of `read_once`; fields marked hidden stay out.

    `path` is an absolute folder or an address that pyarrow knows, which driver and
    executors reach. A query keeps its checkpoint's address, which tells its batches
    from those of others.
    """
    df.sparkSession.dataSource.register(OnceSource)
    return visible(df).writeStream.format("tillwater_once").option("path", path).outputMode(
        "append")


def read_once(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of the committed batches, whatever else lies in the folder."""
    store, root = fs.FileSystem.from_uri(path)
    if store.get_file_info(f"{root}/{_COMMITS}").type == fs.FileType.NotFound:
        return spark.createDataFrame([], schema)
    # A name for each task and batch, as Spark's own listing of a table's files.
    commits = spark.read.schema("files array<string>").json(f"{path}/{_COMMITS}/*.json")
    files = [f"{path}/data/{name}" for r in commits.collect() for name in r["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
