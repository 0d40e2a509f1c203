"""Nearest neighbours by inner product: a vantage-point tree per shard.

Vectors are lengthened by one number so that all have the same norm; then the largest
inner product is the smallest Euclidean distance, and the triangle inequality prunes.
Each shard of at most SHARD_ROWS vectors holds a tree of vantage points, each of which
parts its vectors by their median distance; leaves are compared whole. A far side is
skipped if the gap to it, times `factor`, exceeds the distance of the k-th neighbour so far: factor
1 is exact, a larger factor prunes more and may miss neighbours.

Every vector is indexed. Queries are sent to the shards in groups; a task holds one
shard and one group. The best of each shard are scored again in double precision, and
the best of all shards are returned.

Defined cases: vectors that are null, zero, or hold null or non-finite components take
no part, nor do rows with a null id or vectors of another length than the commonest;
fewer candidates than k are all returned; ties go to the smaller id; of rows that share
an id only the smallest vector (by its numbers) takes part; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import cut

SHARD_ROWS = 8_192
QUERY_ROWS = 16_384
LEAF_ROWS = 256
#: Queries whose ties are gathered at once.
TIED_QUERIES = 512
#: Exact. Larger factors lose neighbours once one vector is much longer than the rest: its
#: norm sets what is added to all others, and so how far every query lies from them.
FACTOR = 1.0
#: Slack for rounding in distances, as a share of the largest norm, so that factor 1 is exact.
SLACK = 1e-7


class Tree:
    """A vantage-point tree over the rows of a matrix, as nested tuples of row numbers."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.norms = (points**2).sum(1)
        self.slack = SLACK * float(np.sqrt(self.norms.max(initial=0)))
        self.root = self.grow(np.arange(len(points)))

    def distances(self, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        squares = self.norms[rows][:, None] + (to**2).sum(1)[None] - 2 * self.points[rows] @ to.T
        return np.sqrt(np.maximum(squares, 0))

    def grow(self, rows: np.ndarray):
        if len(rows) <= LEAF_ROWS:
            return rows
        # The vantage point is the row farthest from the first: a corner sees more spread.
        far = rows[int(self.distances(rows, self.points[rows[:1]])[:, 0].argmax())]
        from_far = self.distances(rows, self.points[[far]])[:, 0]
        order = np.argsort(from_far, kind="stable")
        half = len(rows) // 2
        inner, outer = rows[order[:half]], rows[order[half:]]
        return far, from_far[order[half - 1]], from_far[order[half]], self.grow(inner), self.grow(
            outer)

    def search(
        self, queries: np.ndarray, k: int, factor: float,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of the k nearest rows of each query, -1 where there are fewer; distances."""
        found = np.full((len(queries), k), -1)
        nearest = np.full((len(queries), k), np.inf)

        def visit(node, who: np.ndarray) -> None:
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                apart = self.distances(node, queries[who]).T
                rows = np.concatenate([found[who], np.broadcast_to(node, apart.shape)], axis=1)
                both = np.concatenate([nearest[who], apart], axis=1)
                best = np.argpartition(both, k - 1, axis=1)[:, :k]
                nearest[who] = np.take_along_axis(both, best, 1)
                found[who] = np.take_along_axis(rows, best, 1)
                return
            vantage, inside, outside, inner, outer = node
            away = self.distances(np.array([vantage]), queries[who])[0]
            first_in = away <= (inside + outside) / 2

            def still_open(some: np.ndarray, gap: np.ndarray) -> np.ndarray:
                worth = factor * gap[some] - self.slack <= nearest[who[some]].max(1)
                return who[some][worth]

            near, far = np.flatnonzero(first_in), np.flatnonzero(~first_in)
            visit(inner, who[near])
            visit(outer, still_open(near, outside - away))
            visit(outer, who[far])
            visit(inner, still_open(far, away - inside))

        visit(self.root, np.arange(len(queries)))
        return found, nearest

    def within(self, queries: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all rows not farther than the query's radius, but for rounding."""
        who_found, rows_found = [np.zeros(0, int)], [np.zeros(0, int)]

        def visit(node, who: np.ndarray) -> None:
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                apart = self.distances(node, queries[who]).T
                x, y = np.nonzero(apart <= radius[who][:, None] + self.slack)
                who_found.append(who[x])
                rows_found.append(node[y])
                return
            vantage, inside, outside, inner, outer = node
            away = self.distances(np.array([vantage]), queries[who])[0]
            reach = radius[who] + 2 * self.slack
            visit(inner, who[away - inside <= reach])
            visit(outer, who[outside - away <= reach])

        visit(self.root, np.arange(len(queries)))
        return np.concatenate(who_found), np.concatenate(rows_found)


def search_shard(
    ids: np.ndarray, x: np.ndarray, own: np.ndarray, q: np.ndarray, longest: float, k: int,
    factor: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, inner product) of the k best rows of a shard for each query."""
    # Equal vectors are one point of the tree. No answer needs more than the k + 1
    # smallest ids of one: own id left out, k of them come before any other.
    order = np.lexsort((ids, *x.T))
    ids, x = ids[order], x[order]
    fresh = np.concatenate([[True], (x[1:] != x[:-1]).any(1)])
    first = np.flatnonzero(fresh)
    count = np.minimum(np.diff(np.append(first, len(ids))), k + 1)
    points = x[first]
    # The added number makes all stored norms equal; queries get 0 there. Only the
    # direction of a query matters for its order; this length brings it nearest.
    extra = np.sqrt(np.maximum(longest - (points**2).sum(1), 0))
    tree = Tree(np.column_stack([points, extra]))
    scale = np.sqrt(longest) / np.sqrt((q**2).sum(1, keepdims=True))
    asked = np.column_stack([q * scale, np.zeros(len(q))])
    # One more than k for the query's own vector, some more to see whether others tie.
    most = min(k + 5, len(points))
    found, nearest = tree.search(asked, most, factor)
    reach = np.sort(nearest, axis=1)[:, min(k, most - 1)]
    tied = (nearest.max(1) <= reach + tree.slack) & (most < len(points))
    who, place = np.nonzero((found >= 0) & ~tied[:, None])
    hit = found[who, place]
    if tied.any():
        # All that lie as near as the last are wanted, as the smaller ids go first.
        parts = [(who, hit)]
        some = np.flatnonzero(tied)
        for at in range(0, len(some), TIED_QUERIES):
            few = some[at : at + TIED_QUERIES]
            x, rows = tree.within(asked[few], reach[few])
            parts.append((few[x], rows))
        who, hit = (np.concatenate(p) for p in zip(*parts, strict=True))
    score = np.einsum("ij,ij->i", q[who], points[hit])
    copies = count[hit]
    at = np.repeat(first[hit] - np.cumsum(copies) + copies, copies) + np.arange(copies.sum())
    who, score = np.repeat(who, copies), np.repeat(score, copies)
    other = ids[at] != own[who]
    who, at, score = who[other], at[other], score[other]
    order = np.lexsort((ids[at], -score, who))
    who, at, score = who[order], at[order], score[order]
    rank = np.arange(len(who)) - np.searchsorted(who, who)
    best = rank < k
    return own[who[best]], ids[at[best]], score[best]


def usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """id and v (doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(v, lambda x: x != 0)
    given = rows.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(
        "id IS NOT NULL AND v IS NOT NULL").where(finite & nonzero)
    return given.groupBy("id").agg(F.min("v").alias("v"))


def nearest(
    rows: DataFrame, is_query: Column, k: int = 20, factor: float = FACTOR,
    id_column: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of each row for which `is_query(id)` holds."""
    points = cut(usable(rows, id_column, vector), "vptree-points")
    width = points.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("width")).first()
    dims = width["width"] if width else 0
    points = points.where(F.size("v") == dims)
    queries = points.where(is_query)
    totals = points.agg(
        F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("queries"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("square")).first()
    n_shards = max(1, -(-totals["n"] // shard_rows))
    n_groups = max(1, -(-totals["queries"] // query_rows))
    longest = float(totals["square"] or 0.0)

    shard = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(n_shards)).cast("int")
    group = F.pmod(F.xxhash64("id", F.lit(4)), F.lit(n_groups)).cast("int")
    # Each shard meets each group of queries in a task of its own.
    stored = points.select(
        shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("group"),
        "id", "v")
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"),
        group.alias("group"), "id", "v")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        def read(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            flat = table.column("v").combine_chunks().flatten().to_numpy()
            return table.column("id").to_numpy(), flat.reshape(-1, dims)

        if not left.num_rows or not right.num_rows:
            return pa.table({
                "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                "score": pa.array([], pa.float64())})
        ids, x = read(left)
        own, q = read(right)
        return pa.table(dict(zip(
            ("query_id", "vec_id", "score"),
            search_shard(ids, x, own, q, longest, k, factor), strict=True)))

    found = stored.groupBy("shard", "group").cogroup(asked.groupBy("shard", "group")).applyInArrow(
        answer, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
