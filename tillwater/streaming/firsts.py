"""First records per visitor on a stream.

Both operators reduce each visitor's event-time window to its earliest record
with an ordinary aggregation. Only these, at most one per visitor and window,
reach the keyed state, and they come in window order: a window is emitted once
the watermark passes its end, so later batches hold later windows only.

The state can start from what earlier runs knew: `seen` has a row for each
visitor (and day) that was let through before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillwater.functions import day_of
from tillwater.streaming.answers import JSON, STATES, answered
from tillwater.streaming.state import Chunks, chunk_rows, has_variable, state_variable

# No leading underscores: the state runner would rename such columns.
_OUT = ["first_key", "first_us", "first_tie", "first_wt", "first_row"]
_OUT_SCHEMA = "first_key string, first_us long, first_tie long, first_wt timestamp, first_row string"
_EVER = "ever"
# Chunks of visitors in a state, after which they are put together again.
_MANY_CHUNKS = 16
# A day is over by then, in any zone and with any clock change.
_DAY_STATE_MS = 2 * 86_400_000


class FirstInScope(StatefulProcessor):
    """Lets a visitor's window through when it opens a new scope.

    The state is the scope last let through. It is kept forever, or for
    `keep_ms` of event time after the window that opened it; the scope must be
    over by then.
    """

    def __init__(self, keep_ms: int | None = None):
        self._keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", "scope string, until long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        scope = initialState["scope"].max()
        until = -1
        if self._keep_ms is not None:
            until = int(initialState["until"].max())
            self._handle.registerTimer(max(until, timerValues.getCurrentWatermarkInMs() + 1))
        self._open.update((scope, until))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # The earliest window of each scope, kept up frame by frame: a visitor
        # with a long backlog never stands in memory as a whole.
        earliest = None
        for frame in rows:
            both = frame if earliest is None else pd.concat([earliest, frame])
            earliest = both.sort_values(["first_us", "first_tie"]).drop_duplicates("scope")
        if earliest is None:
            return
        current = self._open.get()[0] if self._open.exists() else None
        opened = earliest[earliest["scope"] != current]
        # Scopes follow one another; one before the open one was let through before.
        if self._keep_ms is not None and current is not None:
            opened = opened[opened["scope"] > current]
        if len(opened):
            until = -1
            if self._keep_ms is not None:
                until = int(opened["first_us"].iloc[-1]) // 1000 + self._keep_ms
                self._handle.registerTimer(until)
            self._open.update((opened["scope"].iloc[-1], until))
            yield opened[_OUT]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # A later scope has a later timer of its own.
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self._open.exists() and self._open.get()[1] <= due:
            self._open.clear()
        return iter(())

    def close(self) -> None:
        pass


class FirstEver(StatefulProcessor):
    """Lets each visitor's earliest window through, once, for all visitors of a bucket.

    The state holds chunks of the visitors let through; a batch adds one for its new ones.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = Chunks(handle.getListState("open_chunks", Chunks.SCHEMA))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._open.add([(k,) for k in initialState["first_key"].drop_duplicates().tolist()])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Kept up frame by frame: a long backlog never stands in memory as a whole.
        earliest = None
        for frame in rows:
            both = frame if earliest is None else pd.concat([earliest, frame])
            earliest = both.sort_values(["first_us", "first_tie"]).drop_duplicates("first_key")
        if earliest is None:
            return
        known, chunks = self._open.read()
        known = {row[0] for row in known}
        fresh = [k not in known for k in earliest["first_key"].tolist()]
        opened = earliest[fresh]
        if len(opened):
            new = [(k,) for k in opened["first_key"].tolist()]
            if chunks >= _MANY_CHUNKS:
                self._open.put([(k,) for k in known] + new)
            else:
                self._open.add(new)
            yield opened[_OUT]

    def close(self) -> None:
        pass


def _firsts(
    pages: DataFrame, key, ts, tie, window, scope, row, keep_ms=None, seen=None, states=None,
) -> DataFrame:
    """(key, time, tie, row as text) of each visitor's first record of each scope.

    `seen` (first_key, scope, until) is what the state knows before the first record. With
    `states` there is one scope, and the visitors share that many states.
    """
    order = F.struct(F.unix_micros(ts).alias("first_us"), F.col(tie).cast("long").alias("first_tie"))
    per_window = pages.groupBy(
        F.window(ts, window).alias("_w"),
        F.col(key).cast("string").alias("first_key"),
        scope.alias("scope"),
    ).agg(F.min(order).alias("_first"), F.min_by(row, order).alias("_record"))
    windows = per_window.select(
        "first_key", "scope", "_first.first_us", "_first.first_tie",
        F.window_time("_w").alias("first_wt"),
        F.to_json("_record", JSON).alias("first_row"),
    )
    processor, by = FirstInScope(keep_ms), "first_key"
    if states is not None:
        processor, by = FirstEver(), "bucket"
        bucket = F.pmod(F.xxhash64("first_key"), F.lit(states)).cast("int")
        windows = windows.withColumn(by, bucket)
        seen = None if seen is None else seen.withColumn(by, bucket)
    return windows.groupBy(by).transformWithStateInPandas(
        processor, _OUT_SCHEMA, "Append", "EventTime",
        initialState=None if seen is None else seen.groupBy(by),
        eventTimeColumnName="first_wt",
    )


def seen_by(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """The visitors, in column `key`, that a stopped query of this module let through.

    For daily visitors `day` is the last day on which each was there. Give it as `seen` to
    a query on a new checkpoint. Windows that were open as the query stopped are not
    in it: the new query's input begins where the watermark stood (`runner.stopped_at`).
    """
    if has_variable(spark, checkpoint, "open_chunks"):
        return chunk_rows(spark, checkpoint, "open_chunks", "first_key string").select(
            F.col("first_key").alias(key), F.lit(None).cast("date").alias("day"))
    known = state_variable(spark, checkpoint, "open").select(
        F.col("key.first_key").alias(key), F.col("value.scope").alias("scope"))
    return known.select(key, F.try_to_date("scope").alias("day"))


def daily_unique_stream(
    pages: DataFrame, key: str, ts: str, tie: str, window: str = "5 seconds",
    tz: str | None = None, seen: DataFrame | None = None,
) -> DataFrame:
    """Each visitor's earliest record of each day; `ts` carries the watermark.

    The record itself passes the keyed state, as text. `seen` holds (key, day) of
    earlier runs: a visitor who was there on that day isn't let through on it again.
    """
    fields = [c for c in pages.columns if c != ts]
    row = F.struct(*fields, F.unix_micros(ts).alias("_event_us"))
    schema = pages.select(row.alias("r")).schema["r"].dataType
    day = day_of(ts, tz).cast("string")
    if seen is not None:
        seen = seen.select(
            F.col(key).cast("string").alias("first_key"), F.col("day").cast("string").alias("scope"),
            (F.unix_millis(F.col("day").cast("timestamp")) + _DAY_STATE_MS).alias("until"))
    firsts = _firsts(pages, key, ts, tie, window, day, row, _DAY_STATE_MS, seen)
    back = firsts.select(F.from_json("first_row", schema, JSON).alias("r")).select("r.*")
    return back.withColumn(ts, F.timestamp_micros("_event_us")).select(*pages.columns)


def flag_new_visitors_stream(
    pages: DataFrame, key: str, ts: str, tie: str, flag: str = "is_new",
    window: str = "5 seconds", seen: DataFrame | None = None, spread: int = 4,
    states: int | None = STATES,
) -> DataFrame:
    """Every record with `flag` 1 on its visitor's earliest one and 0 elsewhere.

    The few first records come from the keyed state of `_firsts`. The records wait
    for theirs in a state of their own, `spread` parts for each visitor, until
    their window is over; then any that had no answer isn't a first one. So
    none is lost after a quiet time, and late ones leave with 0. `seen` holds the
    visitors (in column `key`) of earlier runs, none of whose records are new.
    Visitors share `states` states, or have one each (None); see `answered`. `ts` carries the watermark; the result has none.
    """
    if seen is not None:
        seen = seen.select(
            F.col(key).cast("string").alias("first_key"), F.lit(_EVER).alias("scope"),
            F.lit(-1).cast("long").alias("until"))
    firsts = _firsts(
        pages, key, ts, tie, window, F.lit(_EVER), F.struct(F.lit(1).alias("one")), seen=seen,
        states=states,
    ).select("first_key", "first_us", "first_tie")
    rows = pages.drop(flag).withColumn("_event_us", F.unix_micros(ts)).withColumn(
        ts, F.timestamp_micros("_event_us"))
    marked = answered(
        rows, F.col(key), F.col(ts), F.window(ts, window)["end"],
        firsts, F.col("first_key"), (F.timestamp_micros("first_us"), F.col("first_tie")),
        lifetime="1 day", spread=spread, states=states)
    is_first = (F.col("answer.first_us") == F.col("_event_us")) & (
        F.col("answer.first_tie") == F.col(tie).cast("long"))
    kept = [c for c in pages.columns if c != flag]
    return marked.withColumn(ts, F.timestamp_micros("_event_us")).select(
        *kept, F.when(is_first, 1).otherwise(0).alias(flag))
