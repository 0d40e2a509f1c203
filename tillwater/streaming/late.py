"""Late rows kept: told apart before the window, and let out by themselves.

A window drops a row that comes after the watermark has passed the window's end, and only
counts it. Here every row first passes a state-free stage that sees the
watermark. A row whose window is still open goes on into it. A late one goes on as a group
of its own, in the window that is open now, so one aggregation gives both: the sums, and
each late row with the window that it missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillwater.streaming.answers import JSON

_MARKED = "text string, is_late boolean, end_us long, open_time timestamp"


class MarkLate(StatefulProcessor):
    """Says of each row whether the watermark has passed the end of its window."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for frame in rows:
            late = frame["end_us"] <= passed
            # A time in the row's window, or for a late one in a window open now.
            at = (frame["end_us"] - 1).mask(late, passed + 1)
            yield pd.DataFrame({
                "text": frame["text"], "is_late": late, "end_us": frame["end_us"],
                "open_time": pd.to_datetime(at, unit="us", utc=True)})

    def close(self) -> None:
        pass


def sums_and_late(
    rows: DataFrame, ts: str, window: str, keys: list[str], sums: dict[str, Column],
    spread: int = 64,
) -> DataFrame:
    """Rows (window, keys, sums, late_row, late_count) per window and group, and per late row.

    `ts` carries the watermark. `late_row` is null in the sums of what came in time. Elsewhere
    it is the late row as JSON text, `window` the one it missed and `late_count` the number of
    equal late rows, over which the sums go. Late rows leave when the window that was
    open as they came is closed. Rows are dealt to `spread` groups for the stage.
    """
    row = F.struct(*[c for c in rows.columns if c != ts], F.unix_micros(ts).alias("_us"))
    row_type = rows.select(row.alias("r")).schema["r"].dataType
    given = rows.select(
        F.to_json(row, JSON).alias("text"),
        F.unix_micros(F.window(ts, window)["end"]).alias("end_us"))
    marked = given.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(spread))).groupBy(
        "part").transformWithStateInPandas(
        MarkLate(), _MARKED, "Append", "EventTime", eventTimeColumnName="open_time")
    back = marked.select(
        "text", "is_late", "end_us", "open_time", F.from_json("text", row_type, JSON).alias("r"))
    grouped = back.select(
        "open_time", *[F.col(f"r.{c}").alias(c) for c in rows.columns if c != ts],
        F.timestamp_micros("r._us").alias(ts),
        F.when(F.col("is_late"), F.col("text")).alias("late_row"),
        F.when(F.col("is_late"), F.col("end_us")).alias("missed_us"),
    ).groupBy(F.window("open_time", window).alias("_open"), *keys, "late_row", "missed_us").agg(
        *[c.alias(n) for n, c in sums.items()],
        F.count("late_row").alias("late_count"))
    size = F.unix_micros(F.col("_open.end")) - F.unix_micros(F.col("_open.start"))
    end = F.coalesce("missed_us", F.unix_micros(F.col("_open.end")))
    return grouped.select(
        F.struct(F.timestamp_micros(end - size).alias("start"), F.timestamp_micros(end).alias("end"))
        .alias("window"), *keys, *sums, "late_row", "late_count")


def with_late(table: DataFrame, late: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """A table of sums to which the late rows' sums are added."""
    return table.select(*keys, *sums).unionByName(late.select(*keys, *sums)).groupBy(*keys).agg(
        *[F.sum(c).cast(table.schema[c].dataType).alias(c) for c in sums])
