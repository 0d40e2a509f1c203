"""Each topic's records as rows of additive measures.

A row has the dimensions, the event time `et` and one or two measures; the
union fills the others with zero.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwater.functions import event_time, is_blank, millis_to_timestamp
from tillwater.schemas import PRODUCT_AMOUNTS, PRODUCT_COUNTS

VISITOR_KEYS = ("vc", "ch", "ar", "is_new")
VISITOR_MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")

# Item type of a product, appraisals that count as good.
SKU_ITEM = "sku_id"
GOOD_APPRAISALS = ("1204", "1205")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- visitors ---------------------------------------------------------------

def is_entry(page: str = "page") -> Column:
    """No page before this one."""
    return is_blank(f"{page}.last_page_id")


def _visitor_row(records: DataFrame, **measures: str) -> DataFrame:
    """Measures are SQL over the record."""
    return records.selectExpr(
        "timestamp_millis(ts) AS et",
        *[f"CAST(common.{k} AS STRING) AS {k}" for k in VISITOR_KEYS],
        *[f"CAST({measures.get(m, '0')} AS BIGINT) AS {m}" for m in VISITOR_MEASURES],
    )


def page_views(pages: DataFrame) -> DataFrame:
    """Page views, time spent and session starts, all from one pass."""
    return _visitor_row(
        pages, pv_ct="1", dur_sum="coalesce(page.during_time, 0)",
        sv_ct="IF(coalesce(page.last_page_id, '') = '', 1, 0)",
    )


def unique_visits(uv: DataFrame) -> DataFrame:
    return _visitor_row(uv, uv_ct="1")


def jumps(uj: DataFrame) -> DataFrame:
    return _visitor_row(uj, uj_ct="1")


# --- products ---------------------------------------------------------------

def product_fields(
    sku: str, et: str, kind: str | None = None, order_id: str = "NULL", **measures: str,
) -> dict[str, str]:
    """The fields of a measure row; all arguments but `kind` are SQL over the record.

    `kind` and `order_id` say which order the row belongs to, for counting.
    """
    zero = "CAST(0 AS DECIMAL(20,2))"
    return {
        "et": et, "sku_id": f"try_cast({sku} AS BIGINT)",
        "kind": f"CAST({f"'{kind}'" if kind else 'NULL'} AS STRING)",
        "order_id": f"try_cast({order_id} AS BIGINT)",
        **{m: f"coalesce(try_cast({measures.get(m, '0')} AS BIGINT), 0)" for m in PRODUCT_COUNTS},
        **{
            m: f"coalesce(try_cast({measures.get(m, '0')} AS DECIMAL(20,2)), {zero})"
            for m in PRODUCT_AMOUNTS
        },
    }


def _product_row(records: DataFrame, *args: str, **measures: str) -> DataFrame:
    return records.selectExpr(
        *[f"{sql} AS {name}" for name, sql in product_fields(*args, **measures).items()])


def _struct(fields: dict[str, str]) -> str:
    return f"named_struct({', '.join(f"'{name}', {sql}" for name, sql in fields.items())})"


def log_measures(log: DataFrame, more: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """The measure rows of whole log records, clicks and displays, in one pass.

    The same rows as `clicks` of the page records and `displays` of the display
    records. `more` maps conditions to `product_fields` of further rows, for records
    that carry several topics.
    """
    click = product_fields("page.item", "timestamp_millis(ts)", click_ct="1")
    shown = product_fields(
        "coalesce(page.item, d.item)", "timestamp_millis(ts)", display_ct="1")
    cases = {f"start IS NULL AND page.item_type = '{SKU_ITEM}'": click, **(more or {})}
    single = ", ".join(f"IF({condition}, {_struct(f)}, NULL)" for condition, f in cases.items())
    return log.selectExpr(f"""inline(filter(concat(
        array({single}),
        coalesce(transform(IF(start IS NULL, displays, NULL), d -> IF(
            coalesce(page.item_type, d.item_type) = '{SKU_ITEM}', {_struct(shown)}, NULL
        )), array(IF(false, {_struct(click)}, NULL)))
    ), r -> r IS NOT NULL))""")


def split_usable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(measure rows, rows whose product number or time cannot be read).

    The second belong into a reject output: a window would drop the rows without a
    time, and a product without a number names nothing.
    """
    usable = F.col("et").isNotNull() & F.col("sku_id").isNotNull()
    return rows.filter(usable), rows.filter(~usable)


def clicks(pages: DataFrame) -> DataFrame:
    hits = pages.filter(F.col("page.item_type") == SKU_ITEM)
    return _product_row(hits, "page.item", "timestamp_millis(ts)", click_ct="1")


def displays(shown: DataFrame) -> DataFrame:
    """From flattened display records."""
    hits = shown.filter(F.col("item_type") == SKU_ITEM)
    return _product_row(hits, "item", "timestamp_millis(ts)", display_ct="1")


def favors(favor: DataFrame) -> DataFrame:
    return _product_row(favor, "sku_id", event_time(favor, "create_time"), favor_ct="1")


def carts(cart: DataFrame) -> DataFrame:
    return _product_row(cart, "sku_id", event_time(cart, "create_time"), cart_ct="1")


def orders(wide: DataFrame) -> DataFrame:
    return _product_row(
        wide, "sku_id", event_time(wide, "create_time"), "order", "order_id",
        order_sku_num="sku_num", order_amount="split_total_amount",
    )


def payments(wide: DataFrame) -> DataFrame:
    return _product_row(
        wide, "sku_id", event_time(wide, "payment_create_time"), "paid", "order_id",
        payment_amount="split_total_amount",
    )


def refunds(refund: DataFrame) -> DataFrame:
    return _product_row(
        refund, "sku_id", event_time(refund, "create_time"), "refund", "order_id",
        refund_amount="total_amount",
    )


def comments(comment: DataFrame) -> DataFrame:
    return _product_row(
        comment, "sku_id", event_time(comment, "create_time"), **comment_counts("appraise"))


def comment_counts(appraise: str) -> dict[str, str]:
    good = ", ".join(f"'{a}'" for a in GOOD_APPRAISALS)
    return dict(comment_ct="1", good_comment_ct=f"IF({appraise} IN ({good}), 1, 0)")


# --- keywords ---------------------------------------------------------------

def searches(pages: DataFrame) -> DataFrame:
    """Search texts. `page` may be a struct or a map.

    On a stream the other pages stay as rows without a text, so that they too
    move the watermark; Spark would push a filter below it.
    """
    page = F.col("page")
    found = (
        (page["page_id"] == "good_list")
        & (page["item_type"] == "keyword")
        & page["item"].isNotNull()
    )
    if pages.isStreaming:
        text = F.when(found, page["item"])
    else:
        pages, text = pages.filter(found), page["item"]
    return pages.select(text.alias("kw"), millis_to_timestamp("ts").alias("et"))
