"""Connected components of an edge table, by alternating large and small stars.

Each round hangs a node's larger neighbours on its smallest one, then its smaller
neighbours; minima are aggregated, so a node with very many neighbours needs no list. A
round is written to the shared folder, and the rounds end when an edge set repeats.

Defined cases: null ends and loops are ignored; repeated edges count once; no edges, no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node."""
    now = cut(
        edges.where("a <> b").select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        purpose)
    mark = fingerprint(now)
    while mark[0]:
        ways = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written first, so that the join can split the rows of a node with many edges.
        least = cut(ways.groupBy("u").agg(F.min("v").alias("m")), f"{purpose}-least")
        large = cut(
            ways.where("v > u").join(least, "u").select(
                F.col("v").alias("u"), F.least("m", "u").alias("v")),
            f"{purpose}-large")
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")), f"{purpose}-least")
        small = large.join(least, "u")
        following = cut(
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where("v <> m").select(
                F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))
            .distinct(),
            purpose)
        after = fingerprint(following)
        now, done = following, after == mark
        mark = after
        if done:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def fingerprint(edges: DataFrame) -> tuple[int, int, int]:
    """Number of edges and two sums of their hashes: equal for equal sets."""
    row = edges.select(F.xxhash64("u", "v").alias("h")).agg(
        F.count("*").alias("n"), F.sum(F.col("h").bitwiseAND((1 << 31) - 1)).alias("low"),
        F.sum(F.shiftrightunsigned("h", 33)).alias("high")).first()
    return row["n"], row["low"] or 0, row["high"] or 0


def labels(n: int, left: np.ndarray, right: np.ndarray, start: np.ndarray | None = None):
    """Smallest reachable index for each of n local nodes, by hooking and pointer jumping."""
    label = np.arange(n) if start is None else start
    while True:
        a, b = label[left], label[right]
        differ = a != b
        if not differ.any():
            return label
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
