"""Quality classifier: random Fourier features of document statistics, ridge, isotonic.

Statistics of each whole text are standardised and mapped to cosines of random
projections, whose inner products approximate a Gaussian kernel. Partitions sum normal
equations per fold, ridge weights are solved from the sums, and out-of-fold scores,
counted in bins, give a monotone calibration to probabilities (pool adjacent violators).

`fit` learns from at most MOST_ROWS labelled rows (a documented bound; the lowest hashes
of doc_id are taken beyond it). `score` covers every row.

Defined cases: a null text is empty and all statistics of an empty text are 0; without
any label, or with one class only, the score is the share of good labels (0.5 without
labels); a document with several labels counts with their mean, halves up; repeated
rows are scored alike; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut, mapped, pieces, raw_bytes, remainder, sums_between, texts
from tillwater.llm.labelled import bounded, one_label_each

MOST_ROWS = 200_000
N_FEATURES = 256
N_PARTS = 16
N_FOLDS = 4
N_BINS = 400
RIDGE = 1e-3
SEED = 20
# Bin edges reach a little beyond the labels, as ridge scores do.
LOW, HIGH = -0.5, 1.5

# Byte classes that are counted; other bytes are class 0.
CLASSES = {
    1: b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2: b"0123456789", 3: b" \t\r\x0b\x0c", 4: b"\n",
    5: b".,;:'", 6: b"!?", 7: b"|", 8: b"#$%&*+=<>@^_~\\/", 9: b"()[]{}\"-",
    10: bytes(range(128, 256)),
}
CLASS_OF = np.zeros(256, np.uint8)
for number, members in CLASSES.items():
    CLASS_OF[list(members)] = number
STATISTICS = len(CLASSES) + 9


def word_statistics(text: str) -> tuple[float, ...]:
    """Repetition and shape of the words and lines of one text."""
    words = text.split()
    if not words:
        return (0.0,) * 7
    n = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    lines = text.split("\n")
    again = sum(map(str.__eq__, words, words[1:]))
    return (
        lengths.mean() / 10, lengths.std() / 10, len(set(words)) / n, again / n,
        len(set(lines)) / len(lines), sum(w.isupper() for w in words) / n,
        (lengths <= 3).sum() / n,
    )


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS numbers for each text."""
    held, starts = raw_bytes(column)
    size = np.diff(starts)
    found = CLASS_OF[held]
    per_byte = 1 / np.maximum(size, 1)
    counted = [sums_between(found == k, starts) * per_byte for k in CLASSES]
    worded = np.array([word_statistics(t) for t in column.to_pylist()]).reshape(len(size), 7)
    n_words = sums_between((found == 3) | (found == 4), starts) + (size > 0)
    logs = [np.log1p(size) / 10, np.log1p(n_words) / 10]
    return np.column_stack([*counted, *logs, worded]).astype(np.float32)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rows = statistics(piece.column(1))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), lists.cast(pa.list_(pa.float32()))], names=["doc_id", "x"])

    return mapped(texts(docs), run, "doc_id long, x array<float>")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Model:
    """Everything that scoring needs; its size does not depend on the data."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        cosines = np.cos(z @ self.directions + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.column_stack([cosines, np.ones(len(z))])

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.knots, self.values), 0, 1)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted least squares under monotony: block centres and block means."""
    blocks: list[list[float]] = []
    for x, y, w in zip(at, mean, weight, strict=True):
        blocks.append([x * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    table = np.array(blocks)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def constant(share: float) -> Model:
    none = np.zeros(STATISTICS)
    return Model(
        none, none + 1, np.zeros((STATISTICS, 1)), np.zeros(1), np.zeros(2),
        np.array([0.0]), np.array([share]))


def fit(rows: DataFrame, most: int = MOST_ROWS) -> Model:
    """A model from labelled rows (doc_id, x, y)."""
    totals = rows.agg(F.count("*").alias("n"), F.sum("y").alias("good")).first()
    n, good = totals["n"], totals["good"] or 0
    if n == 0 or good in (0, n):
        return constant(good / n if n else 0.5)
    sample = cut(
        bounded(rows, n, most)
        .select("x", "y", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(N_FOLDS)).cast("int")
                .alias("fold"))
        .repartition(N_PARTS),
        "quality-sample")
    moments = sample.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")).orderBy("at").collect()
    centre = np.array([m["mean"] for m in moments])
    scale = np.array([m["sd"] if m["sd"] > 1e-6 else 1.0 for m in moments])
    random = np.random.default_rng(SEED)
    directions = random.normal(0, 1 / np.sqrt(len(centre)), (len(centre), N_FEATURES))
    shifts = random.uniform(0, 2 * np.pi, N_FEATURES)
    model = Model(
        centre, scale, directions, shifts, np.zeros(N_FEATURES + 1), np.zeros(1), np.zeros(1))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((N_FOLDS, N_FEATURES + 1, N_FEATURES + 2))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            phi = model.features(matrix(batch.column(0)))
            y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for k in range(N_FOLDS):
                own = phi[fold == k]
                total[k] += own.T @ np.column_stack([own, y[fold == k]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(N_FOLDS), pa.int32()),
             pa.array([t.tobytes() for t in total], pa.binary())], names=["fold", "part"])

    # At most N_PARTS sums of one fixed size per fold come back.
    normal = np.zeros((N_FOLDS, N_FEATURES + 1, N_FEATURES + 2))
    for row in mapped(sample, sums, "fold int, part binary").toLocalIterator():
        normal[row["fold"]] += np.frombuffer(row["part"]).reshape(normal.shape[1:])

    def solved(equations: np.ndarray) -> np.ndarray:
        a, b = equations[:, :-1], equations[:, -1]
        return np.linalg.solve(a + RIDGE * max(a[-1, -1], 1) / 100 * np.eye(len(a)), b)

    whole = normal.sum(0)
    held_out = [solved(whole - own) for own in normal]
    model.weights = solved(whole)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, N_BINS), np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            phi = model.features(matrix(batch.column(0)))
            y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            raw = np.einsum("ij,ij->i", phi, np.array(held_out)[fold])
            at = ((raw - LOW) / (HIGH - LOW) * N_BINS).astype(int).clip(0, N_BINS - 1)
            count[0] += np.bincount(at, minlength=N_BINS)
            count[1] += np.bincount(at, weights=y, minlength=N_BINS).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(N_BINS), pa.int32()), pa.array(count[0]), pa.array(count[1])],
            names=["bin", "n", "good"])

    bins = mapped(sample, binned, "bin int, n long, good long").groupBy("bin").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good")).where("n > 0").orderBy("bin").collect()
    at = np.array([LOW + (b["bin"] + 0.5) * (HIGH - LOW) / N_BINS for b in bins])
    weight = np.array([b["n"] for b in bins], float)
    model.knots, model.values = isotonic(at, np.array([b["good"] for b in bins]) / weight, weight)
    return model


def score(measures: DataFrame, model: Model) -> DataFrame:
    """doc_id and the calibrated score of every row of `measures`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            raw = model.features(matrix(batch.column(1))) @ model.weights
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.calibrated(raw))], names=["doc_id", "score"])

    return mapped(measures, run, "doc_id long, score double")


def classify(
    docs: DataFrame, labels: DataFrame, name: str = "quality", folds: int = 5, held_out: int = 0,
    threshold: float = 0.3,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; held-out labels are never learned."""
    measures = cut(measured(docs), "quality-statistics")
    training = measures.where(remainder("doc_id", folds) != held_out).join(
        one_label_each(labels, name), "doc_id")
    model = fit(training)
    return score(measures, model).select(
        "doc_id", (remainder("doc_id", folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
