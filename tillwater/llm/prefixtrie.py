"""Conversation prefix trie from sorted sequences, without building a tree.

A turn is a digest of its role and text, a conversation the sequence of its digests.
Equal sequences become one row with a weight. The rows are sorted over the whole table
by range, so that each part of the table is a block of neighbours. In a block, the longest
common prefixes (LCP) of neighbours get a sparse table of range minima. Every prefix that
its row is the first to have is a candidate, and each binary-searches, by itself, how far
to the left and to the right the minima stay at or above its depth. That interval holds
its members; prefix sums over the rows give what the node has to say, without a stack.

Blocks know the rows next to them (written as a small table of ends), so a prefix belongs
to the block of its very first row and every sum over a block adds up. Only nodes that reach beyond
their block, at most two paths for each, meet again in one aggregation.

The ids that end at a node are hashed in ascending order. They are sorted over the table
by range, too, and written as text where they lie; a task then only reads the finished text
of a class that spans several parts, in chunks, so no list of ids is ever held.

Defined cases: null turns come first, turns of equal number in the order of their digests
(of role and text); null role or text is empty; rows without a conv_id belong to no
conversation; repeated rows are turns of their own; an empty table has no nodes, not even a root;
other columns are never read. The 24 bytes a turn of one conversation must fit into a task,
and so must those of a block of rows, about MOST_TURNS turns by the average.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut, mapped

#: Bytes of a turn's digest: enough that no two turns of any corpus share one.
WIDTH = 16
#: Turns that a block of sorted rows holds on average.
MOST_TURNS = 500_000
#: Ids of a class that are written as one text.
IDS_AT_ONCE = 100_000
NOTHING = hashlib.sha256(b"").hexdigest()
NODES = (
    "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the digests and text bytes of each conversation's turns in order."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The role's length keeps (role, text) pairs apart that join to one string.
    whole = F.concat_ws("", F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
            F.octet_length(text).cast("long").alias("size")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["size"])).alias("turns"))


def rebuilt(convs: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Conversations that start with the first `head` turns of conversation `base`.

    `head` is at most `most`; what follows are the conversation's own turns after so many.
    """
    starts = convs.select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("start"))
    wanted = convs.withColumn("base", base).withColumn("head", head)
    own = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns"), F.lit(1)))
    none = F.slice("turns", 1, 0)
    return wanted.join(starts, "base", "left").select(
        "conv_id",
        F.concat(F.coalesce(F.slice("start", 1, F.col("head")), none), own).alias("turns"))


def classes(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences (class, key, sizes, conv_id, weight); each row's (class, conv_id).

    The key is the digests one after another, so a prefix sorts before what it starts.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    rows = cut(
        convs.select("conv_id", key.alias("key"), F.col("turns.size").alias("sizes")).withColumn(
            "class", F.substring(F.unhex(F.sha2("key", 256)), 1, WIDTH)),
        "trie-rows")
    # Equal sequences are as one before they are shuffled.
    distinct = rows.groupBy("class").agg(
        F.first("key").alias("key"), F.first("sizes").alias("sizes"),
        F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"))
    return distinct, rows.select("class", "conv_id")


def endings(members: DataFrame, at_once: int = IDS_AT_ONCE) -> DataFrame:
    """(class, ends_sha256): of each class's ids, ascending, joined by commas."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of neighbouring ids; a class that lies within the part is hashed at once."""
        held: list[tuple[bytes, int, str, str | None]] = []
        first: bytes | None = None
        now: bytes | None = None
        texts: list[str] = []
        start, whole = 0, True

        def settle(inside: bool) -> None:
            nonlocal texts, whole
            if texts:
                text = ",".join(texts)
                if inside and whole and now != first:
                    held.append((now, start, "", hashlib.sha256(text.encode()).hexdigest()))
                else:
                    held.append((now, start, text, None))
                    whole = False
            texts = []

        def answer() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) if held else [[]] * 4
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    columns, (pa.binary(), pa.int64(), pa.string(), pa.string()), strict=True)],
                names=["class", "start", "text", "digest"])

        for batch in batches:
            ids = pc.cast(batch.column(1), pa.string()).to_pylist()
            for mark, number, text in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), ids, strict=True):
                if first is None:
                    first = mark
                if mark != now or len(texts) >= at_once:
                    settle(mark != now)
                    whole = whole if mark == now else True
                    now, start = mark, number
                texts.append(text)
            yield answer()
        settle(False)
        yield answer()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The digest of each class's texts in order."""
        now, state = None, None

        def answer(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([m for m, _ in done], pa.binary()),
                 pa.array([d for _, d in done], pa.string())], names=["class", "ends_sha256"])

        for batch in batches:
            done = []
            for mark, text, digest in zip(
                    batch.column(0).to_pylist(), batch.column(2), batch.column(3).to_pylist(),
                    strict=True):
                if mark != now:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = mark, None
                    if digest:
                        done.append((now, digest))
                        continue
                    state = hashlib.sha256(text.as_buffer())
                else:
                    state.update(b",")
                    state.update(text.as_buffer())
            yield answer(done)
        if state:
            yield answer([(now, state.hexdigest())])

    sorted_ids = members.repartitionByRange("class", "conv_id").sortWithinPartitions(
        "class", "conv_id")
    written = mapped(sorted_ids, write, "class binary, start long, text string, digest string")
    return mapped(
        written.repartition("class").sortWithinPartitions("class", "start"), read,
        "class binary, ends_sha256 string")


class Minima:
    """Range minima in constant time: level k holds the minima of 2**k neighbours."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << len(self.levels) - 1:
            last, step = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of values[low : high + 1] for each pair; high is not below low."""
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            values = self.levels[k]
            out[at] = np.minimum(values[low[at]], values[high[at] - (1 << k) + 1])
        return out


def extents(minima: Minima, rows: np.ndarray, depths: np.ndarray, n: int):
    """First and last row that share `depths` turns with `rows`, each by binary search.

    `minima` is over lcp, where lcp[i] is what row i shares with row i - 1.
    """
    left_low, left = np.zeros(len(rows), np.int64), rows.copy()
    while (open_ := np.flatnonzero(left_low < left)).size:
        middle = (left_low[open_] + left[open_]) // 2
        shares = minima.between(middle + 1, rows[open_]) >= depths[open_]
        left[open_[shares]] = middle[shares]
        left_low[open_[~shares]] = middle[~shares] + 1
    right, right_high = rows.copy(), np.full(len(rows), n - 1)
    while (open_ := np.flatnonzero(right < right_high)).size:
        middle = (right[open_] + right_high[open_] + 1) // 2
        shares = minima.between(rows[open_] + 1, middle) >= depths[open_]
        right[open_[shares]] = middle[shares]
        right_high[open_[~shares]] = middle[~shares] - 1
    return left, right


def shared_turns(keys: list[bytes]) -> np.ndarray:
    """What each key shares with the one before it, in turns; -1 for the first."""
    out = np.full(len(keys), -1, np.int64)
    for n in range(1, len(keys)):
        a, b = keys[n - 1], keys[n]
        size = min(len(a), len(b))
        if a[:size] == b[:size]:
            out[n] = size // WIDTH
        else:
            differ = np.frombuffer(a, np.uint8, size) != np.frombuffer(b, np.uint8, size)
            out[n] = int(differ.argmax()) // WIDTH
    return out


def path(key: bytes, depth: int) -> list[bytes]:
    """Names of a row's prefixes of 0 to `depth` turns."""
    state, out = hashlib.sha256(), []
    for d in range(depth + 1):
        if d:
            state.update(key[(d - 1) * WIDTH : d * WIDTH])
        out.append(state.copy().digest()[:WIDTH])
    return out


def block_nodes(
    keys: list[bytes], sizes: list[np.ndarray], conv: np.ndarray, weight: np.ndarray,
    ends: list[str], before: bytes | None, after: bytes | None,
) -> dict[str, list]:
    """The nodes of a block of sorted rows; `before` and `after` are the keys next to it."""
    n = len(keys)
    beside = shared_turns([before, keys[0]])[1] if before is not None else -1
    beyond = shared_turns([keys[-1], after])[1] if after is not None else -1
    lcp = shared_turns(keys)
    lcp[0] = beside
    length = np.array([len(k) // WIDTH for k in keys], np.int64)
    minima, smallest = Minima(lcp), Minima(conv)
    # A row's candidates are the prefixes it is the first to have; the block's first row
    # also stands for those that started in earlier blocks.
    least = lcp + 1
    least[0] = 0
    offsets = np.concatenate([[0], np.cumsum(length - least + 1)])
    row = np.repeat(np.arange(n), np.diff(offsets))
    depth = np.arange(offsets[-1]) - offsets[row] + least[row]
    left, right = extents(minima, row, depth, n)
    # Each candidate's parent: the one before it, or the node in which its row branches off.
    parent = np.arange(offsets[-1]) - 1
    top = np.flatnonzero(depth == least[row])
    branch, _ = extents(minima, row[top], depth[top] - 1, n)
    parent[top] = offsets[branch] + depth[top] - 1 - least[branch]
    parent[0] = -1
    owned = depth > lcp[row]
    children = np.bincount(
        parent[owned & (parent >= 0)], minlength=len(row)).astype(np.int64)
    following = np.append(lcp[1:], beyond)
    leaves = np.append(0, np.cumsum(following < length))
    members = np.append(0, np.cumsum(weight))
    # Bytes of a row's first turns, as one flat list.
    flat = np.concatenate([np.append(0, np.cumsum(s)) for s in sizes]).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(length + 1)])[:-1]
    total = flat[starts + length]
    every = np.append(0, np.cumsum(weight * total))
    new = np.append(0, np.cumsum(total - flat[starts + np.maximum(lcp, 0)]))
    above = flat[starts[row] + np.maximum(depth - 1, 0)]
    convs = members[right + 1] - members[left]
    # All turns' bytes below the node's parent, less those of each distinct prefix once.
    known = np.maximum(np.maximum(depth - 1, lcp[row]), 0)
    saved = (every[right + 1] - every[left] - above * convs) - (
        new[right + 1] - new[left + 1] + total[row] - flat[starts[row] + known])
    own = smallest.between(left, right)
    outside = ((left == 0) & (depth <= beside)) | ((right == n - 1) & (depth <= beyond))
    names: list[bytes | None] = [None] * len(row)
    for end in {0, n - 1}:
        shared = max(beside if end == 0 else -1, beyond if end == n - 1 else -1)
        marks = path(keys[end], min(shared, int(length[end])))
        depths = np.arange(len(marks))
        # The node of such a prefix is the candidate of the first row that has it.
        first, _ = extents(minima, np.full(len(marks), end), depths, n)
        for at, name in zip(offsets[first] + depths - least[first], marks, strict=True):
            names[at] = name
    up = [names[p] if p >= 0 else None for p in parent]
    named = [int(own[p]) if p >= 0 and names[p] is None else None for p in parent]
    ended = [
        ends[r] if d == length[r] and f == r else None
        for r, d, f in zip(row.tolist(), depth.tolist(), left.tolist(), strict=True)]
    assert [x is not None for x in names] == outside.tolist()
    return dict(
        node=names, parent=up, depth=depth, conv_id=own, parent_conv_id=named, n_convs=convs,
        n_children=children, n_leaves=leaves[right + 1] - leaves[left], saved_tokens=saved,
        ends_sha256=ended)


def prefix_trie(convs: DataFrame, most: int = MOST_TURNS) -> DataFrame:
    """Every distinct prefix of the conversations (conv_id, turns of digest and size).

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.
    """
    distinct, members = classes(convs)
    ends = endings(members)
    rows = cut(distinct.join(ends, "class").drop("class"), "trie-classes")
    turns = rows.agg(F.sum(F.size("sizes") + 1)).first()[0]
    if not turns:
        return convs.sparkSession.createDataFrame([], NODES).drop("node", "parent")
    blocks = cut(
        rows.repartitionByRange(-(-turns // most), "key").withColumn(
            "block", F.spark_partition_id()), "trie-blocks")
    # A range that isn't the last holds at least the key it ends with, so blocks are
    # numbered without gaps.
    edges = blocks.groupBy("block").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    beside = edges.select(
        (F.col("block") + 1).alias("block"), F.col("high").alias("key"),
        F.lit(-1).alias("side")).unionByName(edges.select(
            (F.col("block") - 1).alias("block"), F.col("low").alias("key"),
            F.lit(1).alias("side")))
    given = blocks.withColumn("side", F.lit(0)).unionByName(beside, allowMissingColumns=True)

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        next_to = dict(zip(side, table["key"].to_pylist(), strict=True))
        table = table.filter(pc.equal(table["side"], 0)).sort_by("key")
        if not table.num_rows:
            return schema.empty_table()
        found = block_nodes(
            table["key"].to_pylist(), [np.array(s, np.int64) for s in table["sizes"].to_pylist()],
            table["conv_id"].to_numpy(), table["weight"].to_numpy(),
            table["ends_sha256"].to_pylist(), next_to.get(-1), next_to.get(1))
        return pa.table({f.name: pa.array(found[f.name], f.type) for f in schema})

    schema = pa.schema([
        (f.strip().split()[0], {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[
            f.strip().split()[1]]) for f in NODES.split(",")])
    nodes = cut(given.groupBy("block").applyInArrow(run, NODES), "trie-nodes")
    # Nodes that reach beyond their block, whole again.
    joined = cut(
        nodes.where("node IS NOT NULL").groupBy("node", "depth").agg(
            F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
            F.first("parent_conv_id").alias("parent_conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("ends_sha256").alias("ends_sha256")),
        "trie-joined")
    above = joined.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    inside = nodes.where("node IS NULL AND parent IS NULL").withColumn(
        "above", F.lit(None).cast("long"))
    below = nodes.where("node IS NULL AND parent IS NOT NULL").unionByName(joined).join(
        above, "parent", "left")
    return inside.unionByName(below).select(
        "conv_id", "depth", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
