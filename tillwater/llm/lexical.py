"""Ranked lexical search by one scan of the documents with an automaton of all item terms.

There is no index of the documents. The terms of the items become an Aho-Corasick
automaton whose every pattern is guarded by a boundary on both sides. It is broadcast, and
one pass over the texts gives each document's length and, for every item term in it, the
number of times. That narrow table is written; document frequencies and lengths are summed
from it. A second pass over it weighs each count, leads it through the automaton's
outputs (term to items) and adds up scores; a task keeps each item's best documents only,
and a window ranks what the tasks kept.

What is broadcast is bounded: items are dealt to rounds of about MOST_PAIRS (item, term)
pairs, and each round scans and scores all documents for its items. An item is never split, so
the terms of one item must fit into a task.

Terms are maximal runs of letters, digits and all characters beyond ASCII; only A-Z are
lower-cased. All arithmetic but the weight's logarithm is in 64-bit integers.

Defined cases: a null text has no terms; a document without terms is never found and isn't
counted in N; equal scores go by doc_id, null ids last, so a document without an id is
counted and found like any other; repeated rows are documents of their own; rows of one
item_id form one item with the terms of all of them; an item without an id is left out, as
no row could name it; an item without a term that stands in a document has no rows; no
documents or no items give none; other columns are never read. A long text is scanned in
parts cut between terms, so a task holds it twice and little more.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import cut, mapped, pieces, texts

TOP = 20
#: (item, term) pairs that are broadcast at once: some 100 MB as an automaton at most.
MOST_PAIRS = 200_000
#: Bytes of a text that the automaton reads at once.
PART = 1 << 20
#: Numbers that a scoring step holds in one array.
AT_ONCE = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of a text to bytes of terms and spaces.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
SCORES = "item_id long, doc_id long, score long"


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of every item with an id."""
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    return items.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(TERM), 0)).alias("term"),
    ).groupBy("item_id", "term").agg(F.count("*").alias("times"))


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Numbers of the terms, each found between two boundaries only."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for n, term in enumerate(terms):
        found.add_word(f" {term} ", n)
    found.make_automaton()
    return found


def count_terms(
    machine: ahocorasick.Automaton, raw: bytes, size: int = PART,
) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms in a text, the item terms among them and their counts."""
    plain = raw.translate(PLAIN)
    total, found, start = 0, [np.zeros(0, np.int64)], 0
    while start < len(plain):
        end = plain.find(b" ", start + size)
        part = plain[start : end if end >= 0 else len(plain)]
        start = start + len(part) + 1
        total += len(part.split())
        found.append(np.fromiter(
            (n for _, n in machine.iter(f" {part.decode()} ")), np.int64))
    return total, *np.unique(np.concatenate(found), return_counts=True)


def counted(docs: DataFrame, terms: list[str], size: int = PART) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: what one scan gives."""
    machine = docs.sparkSession.sparkContext.broadcast(automaton(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rows = [count_terms(machine.value, t.as_buffer().to_pybytes(), size)
                    for t in piece.column(1)]
            ends = pa.array(np.cumsum([0, *(len(r[1]) for r in rows)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([r[0] for r in rows], pa.int64()),
                 pa.ListArray.from_arrays(
                     ends, pa.array(np.concatenate([r[1] for r in rows]), pa.int32())),
                 pa.ListArray.from_arrays(
                     ends, pa.array(np.concatenate([r[2] for r in rows]), pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])

    return mapped(
        texts(docs), run, "doc_id long, n long, terms array<int>, counts array<long>"
    ).where("n > 0")


def best(
    item: np.ndarray, score: np.ndarray, doc: np.ndarray, nameless: np.ndarray, top: int,
) -> np.ndarray:
    """Rows that are among the first `top` of their item."""
    order = np.lexsort((doc, nameless, -score, item))
    firsts = np.flatnonzero(np.append(True, np.diff(item[order]) != 0)) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(firsts, np.diff(np.append(firsts, len(order))))
    return order[rank < top]


def scored(
    table: DataFrame, item_ids: np.ndarray, weights: np.ndarray, starts: np.ndarray,
    outputs: np.ndarray, times: np.ndarray, documents: int, length: int, top: int,
) -> DataFrame:
    """Each task's best documents of every item.

    Term t leads to the items outputs[starts[t] : starts[t + 1]], which hold it `times` times.
    """
    shared = table.sparkSession.sparkContext.broadcast(
        (item_ids, weights, starts, outputs, times))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, weights, starts, outputs, times = shared.value
        fan = np.diff(starts)
        kept = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]
        least = np.zeros(len(item_ids), np.int64)
        at_once = max(1, AT_ONCE // max(1, len(item_ids)))

        def add(doc, nameless, n, ends, terms, counts) -> None:
            nonlocal kept
            slack = 100 - 25 + (25 * n * documents) // length
            row = np.repeat(np.arange(len(n)), np.diff(ends))
            gain = weights[terms] * (
                (1_000_000_000 * counts) // (1000 * counts + 12 * slack[row]))
            sizes = fan[terms]
            before = np.cumsum(sizes) - sizes
            place = np.repeat(starts[terms] - before, sizes) + np.arange(int(sizes.sum()))
            scores = np.zeros((len(n), len(item_ids)), np.int64)
            np.add.at(scores, (np.repeat(row, sizes), outputs[place]),
                      np.repeat(gain, sizes) * times[place])
            # Below an item's last kept score nothing can come in any more.
            at, item = np.nonzero((scores > 0) & (scores >= least))
            rows = [np.concatenate(pair) for pair in zip(
                kept, (item, scores[at, item], doc[at], nameless[at]), strict=True)]
            stays = best(*rows, top)
            kept = [c[stays] for c in rows]
            full = np.bincount(kept[0], minlength=len(least)) >= top
            lowest = np.full(len(least), np.iinfo(np.int64).max)
            np.minimum.at(lowest, kept[0], kept[1])
            least[full] = lowest[full]

        for batch in batches:
            nameless = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            doc = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy()
            terms, counts = batch.column(2), batch.column(3)
            ends = terms.offsets.to_numpy()
            flat = terms.values.to_numpy()
            number = counts.values.to_numpy()
            fans = np.append(0, np.cumsum(fan[flat]))[ends]
            first = 0
            while first < len(n):
                last = int(np.searchsorted(fans, fans[first] + AT_ONCE, side="right")) - 1
                last = min(max(last, first + 1), first + at_once, len(n))
                inside = slice(ends[first], ends[last])
                add(doc[first:last], nameless[first:last], n[first:last],
                    ends[first : last + 1], flat[inside], number[inside])
                first = last
        yield pa.RecordBatch.from_arrays(
            [pa.array(item_ids[kept[0]]), pa.array(kept[2], mask=kept[3]), pa.array(kept[1])],
            names=["item_id", "doc_id", "score"])

    return mapped(table.where("size(terms) > 0"), run, SCORES)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, most: int = MOST_PAIRS, size: int = PART,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `top` documents, the best first."""
    spark = docs.sparkSession
    pairs = cut(item_terms(items), "lexical-items")
    rounds = -(-pairs.count() // most)
    best_of = spark.createDataFrame([], SCORES)
    for turn in range(rounds):
        # About `most` rows, or one item's.
        mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == turn).toPandas()
        if mine.empty:
            continue
        terms, term = np.unique(mine["term"].to_numpy(str), return_inverse=True)
        item_ids, item = np.unique(mine["item_id"].to_numpy(np.int64), return_inverse=True)
        table = cut(counted(docs, terms.tolist(), size), "lexical-counts")
        whole = table.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
        if not whole["documents"]:
            continue
        held = np.zeros(len(terms), np.int64)
        # At most one row a term of this round.
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            held[r["t"]] = r["count"]
        weights = np.floor(
            1000 * np.log((2 * whole["documents"] + 2) / (2 * held + 1))).astype(np.int64)
        order = np.argsort(term, kind="stable")
        best_of = best_of.unionByName(scored(
            table, item_ids, weights, np.searchsorted(term[order], np.arange(len(terms) + 1)),
            item[order], mine["times"].to_numpy(np.int64)[order],
            whole["documents"], whole["length"], top))
    order = Window.partitionBy("item_id").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best_of.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
