"""Windowed statistics. All run on batch and, in append mode, on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillwater.functions import (
    any_positive, event_time, local_text, parse_time, positive_sources, tokenize,
)
from tillwater.operators import measures as m
from tillwater.schemas import PRODUCT_AMOUNTS, PRODUCT_COUNTS, PRODUCT_ORDER_COUNTS
from tillwater.streaming.late import sums_and_late

WINDOW = "5 seconds"

# State rows over which a stream's windows spread their words.
_WORD_LISTS = 16

# From a text column to an array of its distinct words. A dictionary segmenter
# fits in here as a pandas UDF.
Words = Callable[[str], Column]


def _trail(df: DataFrame, delay: str, et: str = "et") -> DataFrame:
    return df.withWatermark(et, delay) if df.isStreaming else df


def _trail_each(inputs: list[DataFrame], delay: str) -> DataFrame:
    """The union of inputs that each have a watermark of their own.

    Spark goes by the slowest of them, so an input that runs ahead makes none of
    the others late; one shared watermark would go by the fastest.
    """
    return m.union_all([_trail(df, delay) for df in inputs])


def _bounds(tz: str | None = None) -> list:
    return [
        local_text("window.start", tz).alias("stt"),
        local_text("window.end", tz).alias("edt"),
    ]


def visitor_stats(
    pages: DataFrame, uv: DataFrame, uj: DataFrame, window: str = WINDOW,
    delay: str = "20 seconds", tz: str | None = None,
) -> DataFrame:
    """Views, visitors, sessions, jumps and time per version, channel, area, newness."""
    rows = [m.page_views(pages), m.unique_visits(uv), m.jumps(uj)]
    return visitor_sums(rows, window, delay, tz)


def visitor_sums(
    rows: list[DataFrame], window: str = WINDOW, delay: str = "20 seconds", tz: str | None = None,
) -> DataFrame:
    """The same from measure rows, an input each with a watermark of its own."""
    sums = _trail_each(rows, delay).groupBy(F.window("et", window), *m.VISITOR_KEYS).agg(
        *[F.sum(c).alias(c) for c in m.VISITOR_MEASURES]
    )
    return sums.select(*_bounds(tz), *m.VISITOR_KEYS, *m.VISITOR_MEASURES)


def visitor_sums_and_late(
    rows: list[DataFrame], window: str = WINDOW, delay: str = "20 seconds", tz: str | None = None,
) -> DataFrame:
    """Streaming `visitor_sums` that also lets late rows out; see `sums_and_late`.

    Where `late_row` is null the row is one of the statistics; elsewhere it is a late
    row's share of the window that it missed, to be added to the serving table.
    """
    sums = sums_and_late(
        _trail_each(rows, delay), "et", window, m.VISITOR_KEYS,
        {c: F.sum(c) for c in m.VISITOR_MEASURES})
    return sums.select(
        *_bounds(tz), *m.VISITOR_KEYS, *m.VISITOR_MEASURES, "late_row", "late_count")


def product_stats(
    rows: list[DataFrame], window: str = WINDOW, delay: str = "10 seconds",
    tz: str | None = None,
) -> DataFrame:
    """Sums and distinct order counts per sku and window.

    `rows` are outputs of the product functions in `measures`. Distinct orders
    are counted by grouping twice, first by (sku, window, kind, order) and then
    by (sku, window). No task ever holds the set of a product's order ids, and
    a hot product's orders are spread over all tasks.
    """
    sums = [F.sum(c).alias(c) for c in (*PRODUCT_COUNTS, *PRODUCT_AMOUNTS)]
    per_order = _trail_each(rows, delay).groupBy(
        F.window("et", window), "sku_id", "kind", "order_id"
    ).agg(*sums)
    per_sku = per_order.groupBy("window", "sku_id").agg(
        *sums,
        *[
            F.count(F.when(F.col("kind") == kind, F.col("order_id"))).alias(name)
            for name, kind in PRODUCT_ORDER_COUNTS.items()
        ],
    )
    return per_sku.select(
        *_bounds(tz), "sku_id", *PRODUCT_COUNTS,
        *[F.col(c).cast("decimal(30,2)").alias(c) for c in PRODUCT_AMOUNTS],
        *PRODUCT_ORDER_COUNTS,
    )


def order_bits(
    rows: DataFrame, keys: list[str], window: str = WINDOW, delay: str = "10 seconds",
    tz: str | None = None, order: str = "order_id",
) -> DataFrame:
    """Which orders each window and group had, as bitmaps that can be merged.

    Counts of windows cannot be added: an order with lines in two windows, or of two
    products of a brand, would count twice. A row here holds 32,768 neighbouring order
    ids as bits (4 KB), which suits ids given in order of time: a window's orders
    then lie in few rows. `rows` has the event time `et`; rows without an order have no bit.
    """
    given = _trail(rows.filter(F.col(order).isNotNull()), delay)
    bits = given.groupBy(
        F.window("et", window), *keys, F.bitmap_bucket_number(F.col(order).cast("long")).alias(
            "bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(order).cast("long"))).alias("bits"))
    return bits.select(*_bounds(tz), *keys, "bucket", "bits")


def distinct_orders(bits: DataFrame, keys: list[str], name: str = "order_ct") -> DataFrame:
    """Exact number of distinct orders of each group, over all its rows of `order_bits`."""
    merged = bits.groupBy(*keys, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*keys).agg(F.sum("n").alias(name))


PROVINCE_KEYS = {
    "province_id": "province_id", "province_name": "province_name",
    "area_code": "province_area_code", "iso_code": "province_iso_code",
    "iso_3166_2": "province_3166_2_code",
}


def province_stats(
    wide: DataFrame, window: str = WINDOW, delay: str = "3 seconds",
    tz: str | None = None,
) -> DataFrame:
    """Order amount and distinct orders per province and window."""
    rows = wide.select(
        F.expr(event_time(wide, "create_time")).alias("et"), "order_id",
        F.col("split_total_amount").cast("decimal(20,2)").alias("amount"),
        *[F.col(source).alias(name) for name, source in PROVINCE_KEYS.items()],
    )
    per_order = _trail(rows, delay).groupBy(
        F.window("et", window), *PROVINCE_KEYS, "order_id"
    ).agg(F.sum("amount").alias("amount"))
    totals = per_order.groupBy("window", *PROVINCE_KEYS).agg(
        F.sum("amount").cast("decimal(30,2)").alias("order_amount"),
        F.count("order_id").alias("order_count"),
    )
    return totals.select(*PROVINCE_KEYS, *_bounds(tz), "order_amount", "order_count")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)`, with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _count_runs(words: Column) -> Column:
    """(keyword, ct) of each distinct word, in one pass over the sorted words."""
    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))
        return _let(starts, lambda at: F.transform(at, lambda i, n: F.struct(
            F.get(s, i).alias("keyword"),
            (F.coalesce(F.get(at, n + 1), F.size(s)) - i).cast("long").alias("ct"))))

    return _let(F.sort_array(words), runs)


def _listed_words(texts: DataFrame, window: str, words: Words) -> DataFrame:
    """(window, keyword, ct) from a state row for each window and list of words."""
    def listed(found: Column) -> Column:
        # Each word is hashed once; the lists then compare numbers.
        placed = F.transform(found, lambda w: F.struct(
            F.pmod(F.xxhash64(w), F.lit(_WORD_LISTS)).cast("int").alias("n"), w.alias("w")))
        return _let(placed, lambda p: F.transform(
            F.sequence(F.lit(0), F.lit(_WORD_LISTS - 1)),
            lambda n: F.transform(F.filter(p, lambda x: x["n"] == n), lambda x: x["w"])))

    lists = texts.select("et", F.posexplode(_let(words("kw"), listed)).alias("list", "found"))
    kept = lists.filter(F.size("found") > 0).groupBy(F.window("et", window), "list").agg(
        F.flatten(F.collect_list("found")).alias("found"))
    return kept.select("window", F.inline(_count_runs(F.col("found"))))


def search_keywords(
    texts: DataFrame, window: str = WINDOW, delay: str = "3 seconds",
    tz: str | None = None, words: Words = tokenize,
) -> DataFrame:
    """How many searches held each word. `texts` has columns kw and et.

    On a stream a window's words lie in `_WORD_LISTS` state rows, by their hash, and not each
    in one of its own; in update mode all words of a list that changed come out.
    """
    if texts.isStreaming:
        counts = _listed_words(_trail(texts, delay), window, words)
    else:
        found = texts.select("et", F.explode(words("kw")).alias("keyword"))
        counts = found.groupBy(F.window("et", window), "keyword").agg(F.count("*").alias("ct"))
    return counts.select(
        *_bounds(tz), "keyword", F.lit("search").alias("source"), "ct"
    )


def product_keywords(
    stats: DataFrame, delay: str = "3 seconds", words: Words = tokenize
) -> DataFrame:
    """Clicks, carts and orders credited to the words of the product's name.

    Emits each (window, word, source) once: on a stream the window end becomes
    the event time again, instead of every update being written.
    """
    counted = ("click_ct", "cart_ct", "order_ct")
    rows = stats.select(
        parse_time("edt").alias("et"), "stt", "edt", "sku_name", *counted
    )
    # In batch, rows without a measure go at once, and the rest is summed per
    # name and window, so that each name is cut into words once. On a stream
    # all rows move the watermark; those without a measure make no pairs.
    if not rows.isStreaming:
        rows = rows.filter(any_positive(*counted)).groupBy("et", "stt", "edt", "sku_name").agg(
            *[F.sum(c).alias(c) for c in counted]
        )
    pairs = _trail(rows, delay).select(
        "et", "stt", "edt", F.explode(words("sku_name")).alias("keyword"),
        positive_sources(*counted).alias("pairs"),
    ).select("et", "stt", "edt", "keyword", F.inline("pairs"))
    sums = pairs.groupBy("et", "stt", "edt", "keyword", "source").agg(F.sum("ct").alias("ct"))
    return sums.select("stt", "edt", "keyword", "source", "ct")
