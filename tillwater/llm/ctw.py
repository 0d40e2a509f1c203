"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions; the node of a decision is the bits of the byte so far
under a context of 0 to DEPTH bytes before it. Each node has a Krichevsky-Trofimov
estimate from its training counts, and each context mixes its own estimate with the
mixture of the contexts one byte longer, weighted by how well either coded the training
texts. The result is one probability per byte and its code length in bits.

How it is spread:
1. Scan tasks count (context, byte) strings of DEPTH + 1 bytes and words; Spark sums them.
2. Strings are dealt by the TOP bytes before the byte, of which a task holds whole
   subtrees (of 256^(DEPTH - TOP + 1) strings at most). There code lengths are summed from
   long contexts to short ones; the few shorter contexts are aggregated by Spark, and the
   mixture goes back from short contexts to long ones.
3. Documents are dealt to blocks of about BLOCK_BYTES. Each block asks for the strings and
   words that it holds, the answers are joined and come back to it, and it sums them per
   document. So the model has no bound, is never broadcast and never leaves Spark.

Words are told apart by a hash of 62 bits.

Texts are lower-cased (A-Z) and taken whole, with an end symbol, so that probabilities
of all texts sum to one; contexts at the start of a text are filled with zero bytes.

Defined cases: a null text is empty; an empty text is one end symbol; a null doc_id
counts as empty text for the fold and is returned as null; without training rows every
estimate is 1/2 per bit; repeated rows are scored alike; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut, groups, mapped, pieces, raw_bytes, remainder, texts

DEPTH = 5
#: Context bytes by which strings are dealt to tasks.
TOP = 3
#: Strings that a task handles at once, rounded up to whole subtrees.
TREE_ROWS = 200_000
BLOCK_BYTES = 48 << 20
#: Blocks are made smaller than that, down to this, to occupy all shuffle partitions.
LEAST_BLOCK_BYTES = 8 << 20
#: Of more blocks, several share a partition.
MOST_PARTITIONS = 20_000
END = 0xFF  # never a byte of UTF-8
LN2 = float(np.log(2))
ROWS_OUT = 200_000
#: Bytes of text that are looked at at once; a place takes some 60 bytes of memory.
PIECE = 2 << 20
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: For the words' hash: a random number for each byte, and 3 modulo 8, so that powers differ.
BYTE_NUMBERS = np.random.default_rng(7).integers(1, 1 << 64, 256, np.uint64)
RADIX = np.uint64(0x9E3779B97F4A7C13)


def strings_of(column: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The (depth + 1)-byte strings at every byte and end, and where each text's begin.

    The byte itself is lowest, its nearest neighbour next.
    """
    held, starts = raw_bytes(column)
    n = len(starts) - 1
    size = np.diff(starts)
    padded = starts[:-1] + np.arange(n) * (depth + 1)  # where each text's filling begins
    line = np.zeros(len(held) + n * (depth + 1), np.uint8)
    keep = np.ones(len(line), bool)
    keep[(padded[:, None] + np.arange(depth)).ravel()] = False
    keep[padded + depth + size] = False
    line[keep] = held
    line[padded + depth + size] = END
    keep[padded + depth + size] = True
    strings = line.astype(np.int64)
    for back in range(1, depth + 1):
        strings[back:] |= line[:-back].astype(np.int64) << (8 * back)
    return strings[keep], starts + np.arange(n + 1)


def powers(n: int) -> np.ndarray:
    """The first n powers of RADIX, modulo 2^64."""
    out = np.full(max(1, n), RADIX, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all words in a row, and where each text's begin.

    A key is a negative number, so that no string has it: 62 bits of a polynomial over a
    random number for each byte, its length and a final mixing.
    """
    held, starts = raw_bytes(column)
    inside = ~IS_SPACE[held]
    edge = np.zeros(len(held) + 1, bool)
    edge[starts] = True
    before, after = np.roll(inside, 1), np.roll(inside, -1)
    first = np.flatnonzero(inside & (~before | edge[:-1])) if len(held) else starts[:0]
    last = np.flatnonzero(inside & (~after | edge[1:])) if len(held) else starts[:0]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    size = last - first + 1
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    with np.errstate(over="ignore"):
        terms = BYTE_NUMBERS[held[inside]] * powers(int(size.max()))[place]
        code = np.add.reduceat(terms, begin) + size.astype(np.uint64) * BYTE_NUMBERS[0]
        code ^= code >> np.uint64(32)
        code *= RADIX
        code ^= code >> np.uint64(29)
    return -(code >> np.uint64(2)).view(np.int64) - 1, np.searchsorted(first, starts)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


def distinct(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each stands at a place that counts as training.

    Sorted as key and flag in one number, which is faster than by the key alone
    with an order to carry; keys leave the highest bit but the sign free.
    """
    if not len(keys):
        return keys, keys
    line = np.sort(keys * 2 + learn)
    key = line >> 1
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[at], np.add.reduceat(line & 1, at)


def tallied(batches: Iterator[pa.RecordBatch], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of batches (.., train, text, lower-case) and their training counts."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    rows = merged = 0
    for piece in pieces(batches, size=PIECE + PIECE // 2):
        train = pc.cast(piece.column("train"), pa.int8()).to_numpy()
        for keys, starts in (strings_of(piece.column("text"), depth), words_of(piece.column("text"))):
            parts.append(distinct(keys, np.repeat(train, np.diff(starts))))
            rows += len(parts[-1][0])
        if rows > 2 * merged + 1_000_000:
            parts = [summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
            rows = merged = len(parts[0][0])
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pc.ascii_lower(batch.column(at)))


def counts(docs: DataFrame, depth: int) -> DataFrame:
    """(key, n): training counts of all strings and of all training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = tallied(lowered(batches), depth)
        keep = (keys >= 0) | (n > 0)
        keys, n = keys[keep], n[keep]
        for at in range(0, len(keys), ROWS_OUT):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at : at + ROWS_OUT]), pa.array(n[at : at + ROWS_OUT])],
                names=["key", "n"])

    return cut(
        mapped(docs.select("train", "text"), run, "key long, n long")
        .groupBy("key").agg(F.sum("n").alias("n")),
        "ctw-counts")


def log_gamma(x: Column) -> Column:
    """Stirling's series, six places up, where it is exact to about 1e-10."""
    z = x + 6
    product = x
    for step in range(1, 6):
        product = product * (x + step)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * float(np.log(2 * np.pi)) + series - F.log(product)


def log_estimate(zeros: Column, ones: Column) -> Column:
    """Log probability that the Krichevsky-Trofimov estimator gives to such counts."""
    return (
        log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - float(np.log(np.pi))
        - log_gamma(zeros + ones + 1.0))


def shorter(node: str, depth: int) -> Column:
    """The node under the nearest `depth` bytes of its context."""
    return F.col(node).bitwiseAND((1 << (8 * depth + 8)) - 1)


def log_gammas(x: np.ndarray) -> np.ndarray:
    z = x + 6
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(product)


class Subtree:
    """All nodes with contexts of `top` to `depth` bytes above some strings.

    Strings that share their nearest `top` context bytes must all be there.
    """

    def __init__(self, strings: np.ndarray, n: np.ndarray, depth: int, top: int) -> None:
        byte = strings & 0xFF
        context = (strings >> 8) << 8
        node = np.concatenate([context | (1 << k) | (byte >> (8 - k)) for k in range(8)])
        self.bit = np.concatenate([(byte >> (7 - k)) & 1 for k in range(8)])
        count = np.tile(n, 8).astype(float)
        nodes, self.leaf = np.unique(node, return_inverse=True)
        ones = np.bincount(self.leaf, weights=count * self.bit, minlength=len(nodes))
        zeros = np.bincount(self.leaf, weights=count, minlength=len(nodes)) - ones
        # Levels from the longest contexts down to `top`: node, estimate, weight, parent.
        self.levels = []
        longer = None
        for d in range(depth, top - 1, -1):
            own = log_gammas(zeros + 0.5) + log_gammas(ones + 0.5) - np.log(np.pi) - log_gammas(
                zeros + ones + 1)
            if longer is None:
                weight, mixed = np.ones(len(nodes)), own
            else:
                weight = 1 / (1 + np.exp(np.minimum(longer - own, 700)))
                mixed = np.logaddexp(own, longer) - LN2
            parents, parent = np.unique(nodes & ((1 << (8 * d)) - 1), return_inverse=True)
            self.levels.append((nodes, (ones + 0.5) / (zeros + ones + 1), weight, parent))
            self.top = {"node": nodes, "zeros": zeros, "ones": ones, "mixed": mixed}
            nodes = parents
            zeros, ones, longer = (
                np.bincount(parent, weights=x, minlength=len(parents))
                for x in (zeros, ones, mixed))
        self.above = nodes

    def bits(self, settled: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """Code length of each string, from the mixture so far at the nodes `above`."""
        for _, estimate, weight, parent in reversed(self.levels):
            settled = settled[parent] + open_[parent] * weight * estimate
            open_ = open_[parent] * (1 - weight)
        one = settled[self.leaf]
        cost = -np.log2(np.where(self.bit == 1, one, 1 - one))
        return cost.reshape(8, -1).sum(0)


def code_lengths(strings: DataFrame, depth: int) -> DataFrame:
    """(key, value): the bits of every string of `strings` (key, n)."""
    top = min(TOP, depth)
    near = F.shiftright("key", 8).bitwiseAND((1 << (8 * top)) - 1)
    placed = strings.select(near.alias("near"), "key", F.col("n"))

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, TREE_ROWS, lambda b: b.num_rows):
            _, key, n = (c.to_numpy() for c in table.columns)
            found = Subtree(key, n, depth, top).top
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in found.values()], names=list(found))

    levels = {top: cut(
        mapped(
            placed.repartition("near").sortWithinPartitions("near"), up,
            "node long, zeros double, ones double, mixed double"),
        f"ctw-depth-{top}")}
    for d in range(top - 1, -1, -1):
        gathered = levels[d + 1].groupBy(shorter("node", d).alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"),
            F.sum("mixed").alias("longer"))
        gathered = gathered.withColumn("own", log_estimate(F.col("zeros"), F.col("ones")))
        high, low = F.greatest("own", "longer"), F.least("own", "longer")
        levels[d] = cut(
            gathered.select(
                "node", "zeros", "ones",
                (1 / (1 + F.exp(F.least(F.col("longer") - F.col("own"), F.lit(700.0)))))
                .alias("weight"),
                (high + F.log1p(F.exp(low - high)) - LN2).alias("mixed")),
            f"ctw-depth-{d}")
    # `settled` is the probability of a 1 mixed so far, `open` the weight still to give.
    above = None
    for d in range(top):
        here = levels[d]
        if above is None:
            here = here.withColumns({"settled": F.lit(0.0), "open": F.lit(1.0)})
        else:
            here = here.withColumn("parent", shorter("node", d - 1)).join(
                above.withColumnRenamed("node", "parent"), "parent")
        estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        above = here.select(
            "node",
            (F.col("settled") + F.col("open") * F.col("weight") * estimate).alias("settled"),
            (F.col("open") * (1 - F.col("weight"))).alias("open"))
    above = cut(above, "ctw-above").withColumn("context", F.shiftright("node", 8))
    # Every subtree gets the nodes of the context one byte shorter.
    given = placed.select("near").distinct().withColumn(
        "context", F.col("near").bitwiseAND((1 << (8 * (top - 1))) - 1)).join(above, "context")
    both = placed.select(
        "near", "key", "n", F.lit(None).cast("double").alias("settled"),
        F.lit(None).cast("double").alias("open"))
    both = both.unionByName(given.select(
        "near", F.col("node").alias("key"), F.lit(None).cast("long").alias("n"), "settled",
        "open"))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, TREE_ROWS, lambda b: b.num_rows):
            own = table.filter(table.column("n").is_valid())
            key, n = own.column("key").to_numpy(), own.column("n").to_numpy()
            tree = Subtree(key, n, depth, top)
            mixture = table.filter(pc.invert(table.column("n").is_valid()))
            nodes, first = np.unique(mixture.column("key").to_numpy(), return_index=True)
            at = first[np.searchsorted(nodes, tree.above)]
            bits = tree.bits(
                mixture.column("settled").to_numpy()[at], mixture.column("open").to_numpy()[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(bits)], names=["key", "value"])

    return mapped(
        both.repartition("near").sortWithinPartitions("near"), down, "key long, value double")


def n_blocks(docs: DataFrame, block_bytes: int, least: int) -> tuple[int, int]:
    """How many blocks, and how many training rows."""
    row = docs.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"),
        F.sum(F.col("train").cast("int")).alias("train")).first()
    size = (row["bytes"] or 0) + row["n"]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // block_bytes), min(partitions, -(-size // least))), row["train"] or 0


def score(
    docs: DataFrame, train: Column, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES,
    least_block: int = LEAST_BLOCK_BYTES,
) -> DataFrame:
    """One row per row of `docs`; the model learns from the rows where `train` holds."""
    flagged = texts(docs).withColumn("train", F.coalesce(train, F.lit(False)))
    blocks, n_train = n_blocks(flagged, block_bytes, least_block)
    counted = counts(flagged, depth)
    words = counted.where("key < 0")
    sums = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    total = (sums["tokens"] or 0) + n_train
    distinct = sums["distinct"] + (1 if n_train else 0)
    values = cut(
        # Bits to seven digits: half the bytes to send. Counts stay exact.
        code_lengths(counted.where("key >= 0"), depth)
        .withColumn("value", F.col("value").cast("float").cast("double"))
        .unionByName(words.select("key", F.col("n").cast("double").alias("value"))),
        "ctw-values")

    salt = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).cast("int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one block as compressed bytes: the text goes through a shuffle."""
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for piece in pieces(lowered(batches)):
            block = piece.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
            rows = []
            for a, b in zip(edges, edges[1:], strict=False):
                some = piece.take(pa.array(order[a:b])).select(["doc_id", "train", "text"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, some.schema, options=options) as out:
                    out.write_batch(some)
                rows.append((int(block[order[a]]), sink.getvalue().to_pybytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.binary())], names=["block", "packed"])

    def unpacked(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Rows in batches of about PIECE: looked up alone, small ones repeat each other."""
        held: list[pa.RecordBatch] = []
        size = 0
        for packed in table.column("packed"):
            for batch in pa.ipc.open_stream(packed.as_buffer()):
                held.append(batch)
                size += batch.nbytes
            if size >= PIECE:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    dealt = mapped(
        flagged.select(salt.alias("block"), "doc_id", "train", "text"), pack,
        "block int, packed binary").repartition(min(blocks, MOST_PARTITIONS), "block")

    def ask(table: pa.Table) -> pa.Table:
        keys, _ = tallied(unpacked(table), depth)
        return pa.table({
            "block": pa.array(np.full(len(keys), table.column("block")[0].as_py(), np.int32)),
            "key": keys})

    asked = dealt.groupBy("block").applyInArrow(ask, "block int, key long")
    answers = asked.join(values, "key").select("block", "key", "value")
    base_norm = float(np.log10(total + distinct + 1))
    names = "doc_id long, train boolean, n_bytes long, n_tokens long, n_known long, " \
        "base_score double, bits double"

    def answer(table: pa.Table, given: pa.Table) -> pa.Table:
        keys, value = given.column("key").to_numpy(), given.column("value").to_numpy()
        order = np.argsort(keys)
        keys, value = keys[order], value[order]

        def look_up(wanted: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            return np.where(keys[at] == wanted, value[at], 0.0) if len(keys) else 0.0 * wanted

        out = []
        for piece in pieces(unpacked(table), size=PIECE + PIECE // 2):
            found, starts = strings_of(piece.column("text"), depth)
            coded = pa.array(found).dictionary_encode()
            per_byte = look_up(coded.dictionary.to_numpy())[coded.indices.to_numpy()]
            cost = np.add.reduceat(per_byte, starts[:-1])
            words, word_starts = words_of(piece.column("text"))
            coded = pa.array(words).dictionary_encode()
            seen = look_up(coded.dictionary.to_numpy())[coded.indices.to_numpy()]
            logs = np.concatenate([[0], np.cumsum(np.log10(seen + 1))])
            hits = np.concatenate([[0], np.cumsum(seen > 0)])
            first, last = word_starts[:-1], word_starts[1:]
            n_tokens = last - first + 1
            base = logs[last] - logs[first] + np.log10(n_train + 1) - n_tokens * base_norm
            out.append(pa.table({
                "doc_id": piece.column("doc_id"), "train": piece.column("train"),
                "n_bytes": np.diff(starts) - 1, "n_tokens": n_tokens,
                "n_known": hits[last] - hits[first] + (1 if n_train else 0),
                "base_score": base, "bits": cost}))
        return pa.concat_tables(out)

    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answer, names)
    return scored.select(
        "doc_id", "train", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        "base_score", (F.col("bits") * -float(np.log10(2))).alias("score"), "n_bytes",
        (F.col("bits") / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))


def score_held_out(
    docs: DataFrame, folds: int = 7, held_out: int = 2, depth: int = DEPTH,
) -> DataFrame:
    """Scores of all rows by a model of those whose fold is another than `held_out`."""
    fold = remainder("doc_id", folds)
    return score(docs, fold != held_out, depth).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "n_bytes", "bits_per_byte")
