"""Page jumps: visitors who enter and do not go on.

An entry record is settled by the next record of the same visitor, and only if
that one follows within a short time. So time is cut into chunks, each chunk
also sees the first moments of the next one, and records are grouped by
(visitor, chunk). A visitor with very many records is thereby spread over many
groups, at the cost of a second copy of the few records near a chunk's start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwater.functions import micros

# An entry counts as a jump when the next record is an entry too, or when
# nothing follows in time.
ENTRY_OR_TIMEOUT = "entry_or_timeout"
# Only when nothing follows in time; an entry cut off by another entry is lost.
TIMEOUT_ONLY = "timeout_only"

BATCH_CHUNKS = 60
STREAM_CHUNKS = 2
GRAINS = 50


def user_jump(
    pages: DataFrame, key: str, ts: str, is_entry: Column, tie: str,
    within: str = "5 seconds", mode: str = ENTRY_OR_TIMEOUT, chunk: str | None = None,
    grain: str | None = None,
) -> DataFrame:
    """The entry records that are jumps.

    With e an entry and n the visitor's next record by (ts, tie), e is a jump
    iff there is no n, or n comes `within` or more later, or (first mode) n is
    an entry. On a stream `ts` must carry a watermark, and a jump appears once
    it has passed the end of the chunk at the latest; `grain` is the length of
    the short windows described at `_stream_jumps`.
    """
    if mode not in (ENTRY_OR_TIMEOUT, TIMEOUT_ONLY):
        raise ValueError(f"unknown mode {mode!r}")
    reach = micros(within)
    step = micros(chunk) if chunk else reach * (
        STREAM_CHUNKS if pages.isStreaming else BATCH_CHUNKS
    )
    # Only entries can come out, so only they carry their whole record along.
    narrow = dict(
        _us=F.unix_micros(ts), _tie=F.col(tie), _entry=is_entry,
        _row=F.when(is_entry, F.struct(*pages.columns)),
    )

    def settled(us, next_us, next_entry):
        late = next_us.isNull() | (next_us - us >= reach)
        return late | next_entry if mode == ENTRY_OR_TIMEOUT else late

    if pages.isStreaming:
        fine = micros(grain) if grain else max(reach // GRAINS, 1)
        return _stream_jumps(pages, key, ts, narrow, step, reach, fine, settled)

    overlapping = F.window(ts, f"{step + reach} microseconds", f"{step} microseconds")
    copies = pages.select(
        F.col(key).alias("_key"), overlapping.alias("_w"),
        *[c.alias(n) for n, c in narrow.items()],
    ).withColumn("_start", F.unix_micros("_w.start")).drop("_w")
    order = Window.partitionBy("_key", "_start").orderBy("_us", "_tie")
    following = copies.withColumns(
        {"_next_us": F.lead("_us").over(order), "_next_entry": F.lead("_entry").over(order)}
    )
    return following.filter(
        F.col("_entry")
        & (F.col("_us") < F.col("_start") + step)
        & settled(F.col("_us"), F.col("_next_us"), F.col("_next_entry"))
    ).select("_row.*")


def _stream_jumps(pages, key, ts, narrow, step, reach, fine, settled) -> DataFrame:
    """Two windowed aggregations, since a stream has no `lead`.

    The first puts a visitor's records of one short window in order, which
    settles all but the last of them. The second sees of each short window that
    last record, when the first one came and the jumps already found, and
    settles the last records over a chunk. Both follow one reading of the
    source. The longest list is as long as a chunk has short windows, or as one
    short window has records.
    """
    rows = F.collect_list(F.struct(*[c.alias(n) for n, c in narrow.items()]))
    window = F.window(ts, f"{fine} microseconds")
    lists = pages.groupBy(window.alias("_fine"), F.col(key).alias("_key")).agg(
        F.sort_array(rows).alias("_rows")
    )

    def jumps_of(rows: str, follow, owned=lambda r: F.lit(True)) -> Column:
        """Of a sorted array, the entries settled as jumps by what follows them."""
        paired = F.transform(
            rows, lambda r, i: F.struct(r.alias("r"), F.get(rows, i + 1).alias("n"))
        )
        return F.transform(
            F.filter(paired, lambda p: owned(p["r"]) & follow(p["r"], p["n"])),
            lambda p: p["r"]["_row"],
        )

    inside = jumps_of("_rows", lambda r, n: n.isNotNull() & r["_entry"] & settled(
        r["_us"], n["_us"], n["_entry"]
    ))
    first, last = F.get("_rows", F.lit(0)), F.element_at("_rows", -1)
    ends = lists.select(
        "_key", inside.alias("_inside"), F.window_time("_fine").alias("_at"),
        last["_us"].alias("_us"), last["_entry"].alias("_entry"), last["_row"].alias("_row"),
        first["_us"].alias("_first_us"), first["_entry"].alias("_first_entry"),
    )
    # An owned short window is followed by one that ends this much later at most.
    span = step + reach + fine
    chunks = ends.groupBy(
        F.window("_at", f"{span} microseconds", f"{step} microseconds").alias("_w"), "_key"
    ).agg(
        F.sort_array(F.collect_list(F.struct(
            F.unix_micros("_at").alias("_at_us"), "_us", "_entry", "_first_us",
            "_first_entry", "_row", "_inside",
        ))).alias("_ends")
    )
    end = F.unix_micros("_w.start") + step
    between = jumps_of(
        "_ends",
        lambda r, n: r["_entry"] & settled(r["_us"], n["_first_us"], n["_first_entry"]),
        lambda r: r["_at_us"] < end,
    )
    # A chunk answers for the short windows that end in it.
    settled_inside = F.flatten(F.transform(
        F.filter("_ends", lambda r: r["_at_us"] < end), lambda r: r["_inside"]))
    return chunks.select(
        F.explode(F.concat(settled_inside, between)).alias("_row")
    ).select("_row.*")
