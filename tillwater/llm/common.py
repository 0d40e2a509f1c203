"""What the operators share: document columns, seeded folds, cut points, byte helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.session import scratch_dir

#: Bytes of text that a Python worker handles at once.
PIECE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and the whole text, null as empty; nothing else of `docs` is read."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def text_key(text: str = "text") -> Column:
    """Hash of a text, null as empty: with the doc_id it names a row's text."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES,
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `size` bytes of text each, one row at least."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        if batch.num_rows == 0:
            continue
        _, starts = raw_bytes(batch.column(at))
        first = 0
        while first < batch.num_rows:
            limit = starts[first] + size
            last = max(first + 1, int(np.searchsorted(starts, limit, side="right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column without nulls, and len + 1 offsets into them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or starts[-1] == starts[0]:
        return np.zeros(0, np.uint8), np.zeros(len(starts), np.int64)
    held = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]]
    return held, starts - starts[0]


def sums_between(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of `values` between neighbouring offsets; an empty range gives 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow, named to keep the callers short."""
    return df.mapInArrow(function, schema)


def groups(batches: Iterator[pa.RecordBatch], least: int, size) -> Iterator[pa.Table]:
    """Whole groups of equal first columns, gathered until `size` of them reaches `least`."""
    held: list[pa.RecordBatch] = []
    held_size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        held_size += size(batch)
        if held_size >= least:
            table = pa.Table.from_batches(held).combine_chunks()
            first = table.column(0).to_numpy()
            ends = np.flatnonzero(first[1:] != first[:-1]) + 1
            if len(ends):
                yield table.slice(0, int(ends[-1]))
                held = table.slice(int(ends[-1])).combine_chunks().to_batches()
                held_size = sum(map(size, held))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
