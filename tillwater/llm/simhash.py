"""SimHash near-duplicates by tiled exact comparison.

The bits are cut into blocks. Fingerprints that differ in at most RADIUS bits agree in all
blocks but RADIUS, so distinct fingerprints meet in the cells (choice of the other
blocks, value of their bits); more fingerprints get more blocks. Within a cell they are sorted by population count and compared in tiles, with numpy exclusive-or
and bit counts; tile pairs whose population counts differ by more than the radius are
skipped. A task hands on a spanning star of the links it finds, and the stars of all
cells are joined to components. A cell with more than MOST_IN_CELL fingerprints is cut
into tiles that different tasks compare pair by pair, so no link is lost.

Defined cases: a null text is empty; a text without words has fingerprint zero and is
linked like any other; a text with fewer words than a shingle is one shingle; repeated
rows are returned as often as given; a row with a null doc_id gets its fingerprint but
joins no component (component_id null); other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut, mapped, pieces, texts
from tillwater.llm.components import components, labels

SHINGLE, SEED, BITS, RADIUS = 3, 42, 64, 3
MOST_IN_CELL = 20_000
TILE = 512
#: Cells of at most this many rows are compared all at once.
SMALL_CELL = 48
#: Shingles whose bits are counted at once.
AT_ONCE = 100_000


def fingerprint(raw: bytes) -> int:
    """Bits set in over half of the shingles' hashes."""
    words = raw.lower().split()  # of bytes: A-Z only, ASCII white space
    if not words:
        return 0
    starts = range(max(1, len(words) - SHINGLE + 1))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), AT_ONCE):
        hashes = np.array(
            [xxhash.xxh64_intdigest(b" ".join(words[i : i + SHINGLE]), SEED)
             for i in starts[at : at + AT_ONCE]], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = np.array(
                [fingerprint(t.as_buffer().to_pybytes()) for t in piece.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return mapped(texts(docs), run, "doc_id long, fp long")


def close(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two tiles within the radius."""
    return np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)


def compare(unit: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """A root index for each row: rows of one unit that are linked share it.

    Rows are sorted by unit, then population count. If a unit has both sides, rows are
    compared across sides only; the other units hold their own pairs.
    """
    n = len(fp)
    pops = np.bitwise_count(fp).astype(np.int16)
    root = np.arange(n)
    edges = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1], [True]]))
    sizes = np.diff(edges)
    large = (sizes > SMALL_CELL) | (np.maximum.reduceat(side, edges[:-1]) > 0)
    # Small units together: each row against the one `step` further on.
    rows = np.flatnonzero(np.repeat(~large, sizes))
    small_fp, small_unit = fp[rows], unit[rows]
    left, right = [], []
    for step in range(1, SMALL_CELL):
        same = small_unit[step:] == small_unit[:-step]
        if not same.any():
            break
        i = np.flatnonzero(same)
        near = np.bitwise_count(small_fp[i] ^ small_fp[i + step]) <= radius
        left.append(rows[i[near]])
        right.append(rows[i[near] + step])
    if left:
        root = labels(n, np.concatenate(left), np.concatenate(right), root)
    for first, size in zip(edges[:-1][large], sizes[large], strict=True):
        members = np.arange(first, first + size)
        sides = side[members]
        groups = [(members[sides == 0], members[sides == 1])] if sides.any() else [
            (members, members)]
        for a, b in groups:
            local = np.arange(size)
            for i in range(0, len(a), TILE):
                one = a[i : i + TILE]
                for j in range(i if a is b else 0, len(b), TILE):
                    other = b[j : j + TILE]
                    if (pops[other[0]] - pops[one[-1]] > radius
                            or pops[one[0]] - pops[other[-1]] > radius):
                        continue
                    x, y = close(fp[one], fp[other], radius)
                    local = labels(size, one[x] - first, other[y] - first, local)
            root[members] = first + local
    return root


def linked(units: DataFrame, radius: int) -> DataFrame:
    """Star edges (a, b) between representatives, from rows (unit, side, fp, rep)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def answer(table: pa.Table) -> pa.RecordBatch:
            unit, side, fp, rep = (c.to_numpy() for c in table.columns)
            root = compare(unit, side, fp.view(np.uint64), radius)
            moved = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays(
                [pa.array(rep[moved]), pa.array(rep[root[moved]])], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            unit = table.column(0).to_numpy()
            # All but the last unit is complete.
            starts = np.flatnonzero(unit != unit[-1]) if len(unit) else []
            whole = int(starts[-1]) + 1 if len(starts) else 0
            if whole >= 100_000:
                yield answer(table.slice(0, whole).combine_chunks())
                held = table.slice(whole).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield answer(pa.Table.from_batches(held).combine_chunks())

    return mapped(units, run, "a long, b long")


def masks(radius: int, blocks: int) -> list[int]:
    """Bit masks, one for each choice of blocks - radius of `blocks` blocks of bits.

    Two fingerprints within the radius agree under at least one of them.
    """
    edges = [b * BITS // blocks for b in range(blocks + 1)]
    block = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, blocks - radius)]


def enough_blocks(n: int, radius: int, most: int) -> int:
    """Fewest blocks for which an even spread leaves few fingerprints in a cell."""
    blocks = radius + 1
    while n >> (BITS * (blocks - radius) // blocks) > most // 8 and blocks < 2 * radius:
        blocks += 1
    return blocks


def comparison_units(
    classes: DataFrame, radius: int = RADIUS, most: int = MOST_IN_CELL, blocks: int | None = None,
) -> DataFrame:
    """Rows (unit, side, fp, rep): what has to be compared with each other, unit by unit."""
    blocks = blocks or enough_blocks(classes.count(), radius, most)
    cells = [
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(
            F.lit(m - (1 << BITS) if m >> (BITS - 1) else m).cast("long")).alias("bits"))
        for i, m in enumerate(masks(radius, blocks))]
    placed = classes.select("fp", "rep", F.explode(F.array(*cells)).alias("c")).select(
        "fp", "rep", F.xxhash64("c.mask", "c.bits").alias("cell"))
    # Cells that fell on one number would only be compared more than they need.
    crowded = placed.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > most).select(
        "cell", F.ceil(F.col("n") / (8 * most)).cast("int").alias("salts"))
    marked = placed.join(crowded, "cell", "left")
    pop = F.bit_count("fp")
    calm = marked.where("salts IS NULL").select(
        "cell", F.lit(0).alias("a"), F.lit(0).alias("b"),
        F.lit(0).alias("side"), "fp", "rep")
    # A crowded cell: tiles of (population count, salt); a unit for each pair of tiles
    # whose counts are near. A row goes to the units of its tile and each partner.
    own = marked.where("salts IS NOT NULL").select(
        "cell", "fp", "rep", "salts", pop.alias("pop"),
        (pop * F.col("salts") + F.pmod(F.xxhash64("fp"), F.col("salts"))).cast("int")
        .alias("tile"))
    partner = F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("pop") - radius) * F.col("salts"),
        (F.col("pop") + radius + 1) * F.col("salts") - 1))
    paired = own.withColumn("partner", partner).select(
        "cell", F.least("tile", "partner").alias("a"),
        F.greatest("tile", "partner").alias("b"),
        F.when(F.col("tile") > F.col("partner"), 1).otherwise(0).alias("side"), "fp", "rep")
    both = calm.unionByName(paired.withColumn("side", F.col("side").cast("int")))
    # Units that fell on one number would only be compared more than they need.
    unit = F.xxhash64("cell", "a", "b")
    spread = both.select(unit.alias("unit"), "side", "fp", "rep", F.bit_count("fp").alias("pop"))
    return spread.repartition("unit").sortWithinPartitions("unit", "side", "pop").select(
        "unit", "side", "fp", "rep")


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, most: int = MOST_IN_CELL,
) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of `docs`."""
    marks = cut(fingerprints(docs), "simhash-fingerprints")
    classes = cut(
        marks.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")),
        "simhash-classes")
    edges = linked(comparison_units(classes, radius, most), radius)
    joined = components(edges, "simhash-components")
    named = cut(
        classes.join(joined, classes["rep"] == joined["node"], "left").select(
            "fp", F.coalesce("component", "rep").alias("component_id")),
        "simhash-named")
    return marks.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
