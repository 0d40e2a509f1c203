"""Interval joins and dimension enrichment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillwater.functions import micros

MISSING = "missing_dims"


def _interval(us: int) -> Column:
    return F.expr(f"INTERVAL '{us}' MICROSECOND") if us >= 0 else F.expr(
        f"INTERVAL -'{-us}' MICROSECOND"
    )


def interval_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    left_ts: str, right_ts: str, lower: str, upper: str, slice: str | None = None,
) -> DataFrame:
    """Inner join on key where right_ts lies in [left_ts + lower, left_ts + upper].

    Column names of the two sides must differ. On streams both time columns
    must carry watermarks; the time bounds then let Spark drop old state.

    The key is the whole equality condition, so tables that are bucketed or
    partitioned by it need no shuffle, and adaptive execution splits a key with
    many rows. Where it can't, `slice` (batch only) cuts time into slices that
    join the equality condition: a right row has one slice, a left row those
    that its interval touches. A key is then spread over its slices, and each
    pair is still found exactly once.
    """
    low, high = micros(lower), micros(upper)
    match = (F.col(left_key) == F.col(right_key)) & F.col(right_ts).between(
        F.col(left_ts) + _interval(low), F.col(left_ts) + _interval(high)
    )
    if slice is None or left.isStreaming or right.isStreaming:
        return left.join(right, match)
    width = micros(slice)

    def slice_of(ts: str, shift: int = 0) -> Column:
        at = F.unix_micros(ts) + F.lit(shift)
        return at - F.pmod(at, F.lit(width))

    touched = F.sequence(slice_of(left_ts, low), slice_of(left_ts, high), F.lit(width))
    sliced_left = left.withColumn("_left_slice", F.explode(touched))
    sliced_right = right.withColumn("_right_slice", slice_of(right_ts))
    joined = sliced_left.join(
        sliced_right, match & (F.col("_left_slice") == F.col("_right_slice"))
    )
    return joined.drop("_left_slice", "_right_slice")


@dataclass(frozen=True)
class Dim:
    """A lookup: dimension `table` by `id`, found through column `key`.

    `columns` maps output names to columns or expressions over the table.
    `then` are lookups whose keys are among these outputs. They are joined to
    the dimension itself, so that facts are joined once, not once per level.

    `spread` above 1 cuts each key into that many parts, for a table too large
    to broadcast with keys that hold a large share of the rows: the table is
    repeated per part.
    """

    name: str
    table: DataFrame = field(repr=False)
    key: str
    columns: dict[str, str | Column]
    id: str = "ID"
    then: tuple[Dim, ...] = ()
    spread: int = 1

    def names(self) -> list[str]:
        """This lookup and those that hang on it."""
        return [self.name, *[n for d in self.then for n in d.names()]]

    def outputs(self) -> list[str]:
        return [*self.columns, *[c for d in self.then for c in d.outputs()]]

    def lookup(self, key_type: T.DataType) -> DataFrame:
        """The table to join: key, outputs, and a mark per level that it was found."""
        found = self.table.select(
            F.col(self.id).try_cast(key_type).alias(f"_{self.name}_id"),
            F.lit(True).alias(f"_{self.name}_hit"),
            *[
                (F.col(c) if isinstance(c, str) else c).alias(name)
                for name, c in self.columns.items()
            ],
        )
        for dim in self.then:
            below = dim.lookup(found.schema[dim.key].dataType)
            match = F.col(dim.key) == F.col(f"_{dim.name}_id")
            found = found.join(below, match, "left").drop(f"_{dim.name}_id")
        return found


def enrich(df: DataFrame, dims: list[Dim], mark_missing: bool = False) -> DataFrame:
    """Left-join each lookup in turn; its columns replace any of the same name.

    No broadcast is forced: Spark broadcasts a dimension that is under
    `spark.sql.autoBroadcastJoinThreshold`, by its statistics or by the size
    seen at run time, and shuffles otherwise, where adaptive execution splits
    the partitions of a hot key. With `mark_missing` a column lists the
    lookups that found nothing.
    """
    for dim in dims:
        df = df.drop(*dim.outputs())
        looked_up = dim.lookup(df.schema[dim.key].dataType)
        match = F.col(dim.key) == F.col(f"_{dim.name}_id")
        if dim.spread > 1:
            parts = F.array(*[F.lit(i) for i in range(dim.spread)])
            looked_up = looked_up.withColumn("_dim_part", F.explode(parts))
            # Any part finds the row; the hash only keeps a retried task's
            # output the same.
            simple = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
            part = F.pmod(F.xxhash64(*simple), F.lit(dim.spread)).cast("int")
            df = df.withColumn("_part", part)
            match = match & (F.col("_part") == F.col("_dim_part"))
        df = df.join(looked_up, match, "left").drop(f"_{dim.name}_id", "_part", "_dim_part")
    names = [n for d in dims for n in d.names()]
    hits = [f"_{n}_hit" for n in names]
    if mark_missing:
        missing = [F.when(F.col(h).isNull(), F.lit(n)) for n, h in zip(names, hits)]
        df = df.withColumn(MISSING, F.array_compact(F.array(*missing)))
    return df.drop(*hits)


def split_missing(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with every lookup found, rows that miss one or more)."""
    complete = marked.filter(F.size(MISSING) == 0).drop(MISSING)
    return complete, marked.filter(F.size(MISSING) > 0)
