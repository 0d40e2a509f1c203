"""Toxicity by weak supervision.

1. Terms (words and word beginnings) that set toxic from clean texts are mined from a
   bounded sample of labelled rows and dealt to lexicon voters; a general insult list and
   patterns (density, address, shouting) are further voters. A voter fires or abstains.
2. A generative label model explains how often each combination of votes occurs: the
   class, each voter's accuracy given the class, and pairwise correlations along a tree
   (one parent per voter, chosen by mutual information given the class). It is fitted by
   expectation maximisation on counts of combinations, at most 3 * 2^N_VOTERS of them;
   known labels are clamped.
3. A logistic classifier on hit counts and densities is trained on the posterior labels
   of all rows that aren't held out, by Newton steps on sums over partitions.

Defined cases: a null text is empty; an empty text has no hits and gets the score that
the classifier gives to no hits; without any usable label nothing is mined and the insult
list and the patterns decide; a document with several labels counts with their mean,
halves up; repeated rows are scored alike; other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut, mapped, pieces, remainder, text_key, texts
from tillwater.llm.labelled import bounded, one_label_each

#: Labelled rows from which terms are mined, at most; the label model and the classifier
#: use all rows.
MOST_ROWS = 20_000
MOST_TERMS = 256
#: A mined term is this many times likelier in toxic texts, and in this share of them.
LEAST_RATIO, LEAST_SHARE, LEAST_ROWS = 20.0, 0.01, 3
PREFIXES = (4, 5, 6)
N_LEXICON = 10
N_VOTERS = N_LEXICON + 6
EM_STEPS, NEWTON_STEPS, RIDGE = 30, 7, 1e-3

# Insults of general use, as words.
INSULTS = (
    "arsehole asshole bastard bitch clown creep cretin crap disgusting dumb dumbass fool "
    "freak garbage idiot idiotic idiots imbecile jerk loser losers lowlife lunatic maggot "
    "moron moronic morons pathetic pig prick retard scum shit slut stupid swine trash vermin "
    "whore worthless wretch arschloch depp dummkopf idioten abschaum schwein trottel "
    "connard cretino imbécile ordure salaud salope abruti basura cabron estúpido gilipollas "
    "imbécil mierda"
).split()
ADDRESS = (b"you", b"your", b"youre", b"du", b"dein", b"tu", b"ton", b"eres", b"su")
# Every ASCII byte but letters and digits parts words.
PARTS_WORDS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
SHOUT = re.compile(rb"!!+")


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(PARTS_WORDS).split()


def terms_of(words: set[bytes]) -> set[bytes]:
    """The words, and their beginnings marked with a circumflex."""
    found = set(words)
    for size in PREFIXES:
        found |= {b"^" + w[:size] for w in words if len(w) >= size}
    return found


def mine(sample: DataFrame, n_toxic: int, n_clean: int) -> list[bytes]:
    """Terms of toxic texts from rows (text, y), the commonest first, MOST_TERMS at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[y].update(terms_of(set(words_of(text.as_buffer().to_pybytes()))))
        terms = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(terms), 20_000):
            some = terms[at : at + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.binary()), pa.array([seen[1][t] for t in some], pa.int64()),
                 pa.array([seen[0][t] for t in some], pa.int64())],
                names=["term", "toxic", "clean"])

    counted = mapped(sample.select("text", "y"), count, "term binary, toxic long, clean long")
    ratio = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1))
    best = (
        counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((ratio >= LEAST_RATIO)
               & (F.col("toxic") >= max(LEAST_ROWS, int(LEAST_SHARE * n_toxic))))
        .orderBy(F.desc("toxic"), "clean", "term").limit(MOST_TERMS))
    return [bytes(r["term"]) for r in best.collect()]


FEATURES = N_LEXICON + 8


def by_size(terms: list[bytes]) -> dict[int, dict[bytes, int]]:
    """Voters of the terms: of whole words under 0, of beginnings under their size."""
    voters: dict[int, dict[bytes, int]] = {0: {}, **{size: {} for size in PREFIXES}}
    for i, term in enumerate(terms):
        if term.startswith(b"^"):
            voters[len(term) - 1][term[1:]] = i % N_LEXICON
        else:
            voters[0][term] = i % N_LEXICON
    return voters


def measure(
    text: bytes, mined: dict[int, dict[bytes, int]], insults: frozenset[bytes],
) -> list[float]:
    """Votes, packed into the first number, and the classifier's features of one text."""
    words = words_of(text)
    counts = [0] * N_LEXICON
    insulted: list[bytes] = []
    hit_words: set[bytes] = set()
    whole, beginnings = mined[0], [(size, mined[size]) for size in PREFIXES]
    for word in set(words):
        voters = set()
        if word in whole:
            voters.add(whole[word])
        for size, some in beginnings:
            if word[:size] in some:
                voters.add(some[word[:size]])
        if voters:
            hit_words.add(word)
            for v in voters:
                counts[v] += 1
        if word in insults:
            insulted.append(word)
    n = max(1, len(words))
    hits = sum(w in hit_words for w in words) if hit_words else 0
    rude = sum(w in insults for w in words) if insulted else 0
    addressed = bool(insulted) and any(
        w in insults and any(a in words[max(0, i - 3) : i] for a in ADDRESS)
        for i, w in enumerate(words))
    shouts = len(SHOUT.findall(text))
    loud = shouts / n > 0.3
    votes = [c > 0 for c in counts] + [
        rude > 0, rude / n > 0.002, len(hit_words) > 1, hits / n > 0.01, addressed, loud]
    packed = sum(1 << i for i, v in enumerate(votes) if v)
    logs = np.log1p([*counts, len(hit_words), hits, rude, 100 * hits / n, 100 * rude / n, n / 100])
    return [float(packed), *logs, float(addressed), min(1.0, shouts / n)]


def measured(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, votes (packed), the features x and text_key of every row."""
    mined = by_size(terms)
    insults = frozenset(w.encode() for w in INSULTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rows = np.array([
                measure(t.as_buffer().to_pybytes(), mined, insults) for t in piece.column(1)])
            lists = pa.FixedSizeListArray.from_arrays(
                pa.array(rows[:, 1:].astype(np.float32).ravel()), FEATURES)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(rows[:, 0].astype(np.int32)),
                 lists.cast(pa.list_(pa.float32())), piece.column(2)],
                names=["doc_id", "votes", "x", "text_key"])

    return mapped(
        texts(docs).withColumn("text_key", text_key()), run,
        "doc_id long, votes int, x array<float>, text_key long")


class LabelModel:
    """P(class) * P(vote of each voter | vote of its parent, class)."""

    def __init__(self, votes: np.ndarray, label: np.ndarray, n: np.ndarray) -> None:
        self.bits = (votes[:, None] >> np.arange(N_VOTERS)) & 1
        fired = self.bits.sum(1)
        toxic = np.where(label >= 0, label, np.clip(fired / 4, 0.02, 0.9))
        for step in range(EM_STEPS):
            weight = np.stack([n * (1 - toxic), n * toxic])
            if step % 10 == 0:
                self.parents = self.tree(weight)
            self.estimate(weight)
            toxic = np.where(label >= 0, label, self.posterior(self.bits))

    def tree(self, weight: np.ndarray) -> list[int]:
        """Each voter's parent (-1: none): the spanning tree of most mutual information."""
        gain = np.zeros((N_VOTERS, N_VOTERS))
        for w in weight:
            total = w.sum() + 1e-9
            for a in (0, 1):
                for b in (0, 1):
                    left, right = self.bits == a, self.bits == b
                    both = (left * w[:, None]).T @ right / total + 1e-12
                    alone = np.outer(left.T @ w, right.T @ w) / total**2 + 1e-12
                    gain += total * both * np.log(both / alone)
        parents, inside = [-1] * N_VOTERS, [0]
        while len(inside) < N_VOTERS:
            rest = [i for i in range(N_VOTERS) if i not in inside]
            near, far = max(((i, j) for i in inside for j in rest), key=lambda e: gain[e])
            parents[far] = near
            inside.append(far)
        return parents

    def estimate(self, weight: np.ndarray) -> None:
        total = weight.sum(1)
        self.prior = (total + 1) / (total.sum() + 2)
        # fires[class, voter, vote of the parent]
        self.fires = np.zeros((2, N_VOTERS, 2))
        for y in (0, 1):
            for i, parent in enumerate(self.parents):
                given = self.bits[:, parent] if parent >= 0 else np.zeros(len(self.bits), int)
                for g in (0, 1):
                    own = weight[y] * (given == g)
                    # The prior leans to abstaining, a little less so for the toxic class.
                    self.fires[y, i, g] = (own @ self.bits[:, i] + 0.1 + 0.4 * y) / (own.sum() + 1)

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        log = np.log(self.prior)[:, None] * np.ones(len(bits))
        for y in (0, 1):
            for i, parent in enumerate(self.parents):
                given = bits[:, parent] if parent >= 0 else np.zeros(len(bits), int)
                p = self.fires[y, i][given]
                log[y] += np.log(np.where(bits[:, i] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))


def linear(rows: DataFrame, width: int) -> np.ndarray:
    """Logistic weights (the bias last) from rows (x, target): Newton steps, summed by Spark."""
    weights = np.zeros(width + 1)
    size = (width + 1) * (width + 3)

    for _ in range(NEWTON_STEPS):
        now = weights.copy()

        def sums(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width + 1, width + 3))
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                x = np.column_stack([x, np.ones(len(x))]).astype(float)
                p = 1 / (1 + np.exp(-np.clip(x @ now, -30, 30)))
                target = batch.column(1).to_numpy(zero_copy_only=False)
                total[:, :-2] += x.T @ (x * (p * (1 - p))[:, None])
                total[:, -2] += x.T @ (target - p)
                total[-1, -1] += len(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array(total.ravel())], names=["at", "v"])

        summed = mapped(rows.select("x", "target"), sums, "at int, v double").groupBy("at").agg(
            F.sum("v").alias("v")).collect()
        total = np.zeros(size)
        for r in summed:
            total[r["at"]] = r["v"]
        total = total.reshape(width + 1, width + 3)
        n = max(1.0, total[-1, -1])
        hessian = total[:, :-2] / n + RIDGE * np.eye(width + 1)
        weights = now + np.linalg.solve(hessian, total[:, -2] / n - RIDGE * now)
    return weights


def classify(
    docs: DataFrame, labels: DataFrame, name: str = "toxic", folds: int = 4, held_out: int = 2,
    threshold: float = 0.3, most: int = MOST_ROWS,
) -> DataFrame:
    """doc_id, held_out, score, predicted, text_key of every row; held-out labels are never learned.

    `text_key` tells rows that share an id apart.
    """
    known = cut(
        one_label_each(labels, name).where(remainder("doc_id", folds) != held_out),
        "toxicity-labels")
    n_known = known.count()
    some = bounded(known, n_known, most)
    tally = {r["y"]: r["n"] for r in some.groupBy("y").agg(F.count("*").alias("n")).collect()}
    terms: list[bytes] = []
    if tally.get(1):
        # At most about `most` rows of 12 bytes are broadcast.
        terms = mine(
            texts(docs).join(F.broadcast(some), "doc_id"), tally[1], tally.get(0, 0))
    measures = cut(measured(docs, terms), "toxicity-measures")
    training = measures.where(remainder("doc_id", folds) != held_out).join(known, "doc_id", "left")
    training = training.withColumn("y", F.coalesce("y", F.lit(-1)))
    votes = training.groupBy("votes", "y").agg(F.count("*").alias("n")).collect()
    if not votes:
        votes = [{"votes": 0, "y": -1, "n": 1}]
    model = LabelModel(*(np.array([v[k] for v in votes]) for k in ("votes", "y", "n")))
    every = (np.arange(1 << N_VOTERS)[:, None] >> np.arange(N_VOTERS)) & 1
    posterior = model.posterior(every)

    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(2).to_numpy(zero_copy_only=False)
            guess = posterior[batch.column(1).to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.where(y >= 0, y, guess))], names=["x", "target"])

    labelled = cut(
        mapped(training.select("x", "votes", "y"), targets, "x array<float>, target double"),
        "toxicity-targets")
    weights = linear(labelled, FEATURES)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
            z = x @ weights[:-1] + weights[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50)))),
                 batch.column(2)], names=["doc_id", "score", "text_key"])

    scores = mapped(
        measures.select("doc_id", "x", "text_key"), scored,
        "doc_id long, score double, text_key long")
    return scores.select(
        "doc_id", (remainder("doc_id", folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "text_key")
