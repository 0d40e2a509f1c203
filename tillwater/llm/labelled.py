"""Labelled rows for the classifiers: one label per document, and a bounded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the hash by which a bounded sample is taken.
SLOTS = 1 << 40


def one_label_each(labels: DataFrame, name: str) -> DataFrame:
    """doc_id and y (0 or 1): the mean of a document's labels, halves up; nulls are no labels."""
    given = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(name).cast("double").alias("y"))
    return given.where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(
        F.when(F.avg("y") >= 0.5, 1).otherwise(0).alias("y"))


def bounded(rows: DataFrame, n_rows: int, most: int) -> DataFrame:
    """All of `rows`, or those with the lowest hashes of doc_id so that about `most` stay."""
    if n_rows <= most:
        return rows
    return rows.where(
        F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(SLOTS)) < int(SLOTS * most / n_rows))
