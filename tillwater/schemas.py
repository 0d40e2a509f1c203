"""Record shapes of the shop's topics and tables."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "amount": T.DecimalType(20, 2),
    "timestamp": T.TimestampType(),
}


def shape(**fields) -> T.StructType:
    """`shape(id="bigint", name="string")` as a StructType."""
    return T.StructType(
        [
            T.StructField(name, _KINDS[kind] if isinstance(kind, str) else kind)
            for name, kind in fields.items()
        ]
    )


COMMON = shape(mid="string", vc="string", ch="string", ar="string", is_new="string")
PAGE = shape(
    page_id="string", last_page_id="string", item="string",
    item_type="string", during_time="bigint",
)
DISPLAY = shape(item="string", item_type="string")
START = shape(entry="string", loading_time="bigint")

LOG = shape(
    common=COMMON, page=PAGE, displays=T.ArrayType(DISPLAY), start=START, ts="bigint"
)

CHANGE = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ts", T.LongType()),
    ]
)

ROUTES = shape(
    source_table="string", operate_type="string", sink_type="string",
    sink_table="string", sink_columns="string", sink_pk="string", sink_extend="string",
)

# A feed of the config: its rows, what happened to them, and when.
ROUTE_FEED = T.StructType([
    *ROUTES.fields, T.StructField("op", T.StringType()), T.StructField("ts", T.LongType()),
    T.StructField("tie", T.LongType()),
])

ORDER_INFO = shape(
    id="bigint", province_id="bigint", order_status="string", user_id="bigint",
    total_amount="amount", activity_reduce_amount="amount",
    coupon_reduce_amount="amount", original_total_amount="amount",
    feight_fee="amount", expire_time="string", create_time="string",
    operate_time="string",
)

ORDER_DETAIL = shape(
    id="bigint", order_id="bigint", sku_id="bigint", sku_price="amount",
    sku_num="bigint", sku_name="string", create_time="string",
    split_total_amount="amount", split_activity_amount="amount",
    split_coupon_amount="amount",
)

PAYMENT_INFO = shape(
    id="bigint", order_id="bigint", user_id="bigint", total_amount="amount",
    subject="string", payment_type="string", create_time="string",
    callback_time="string",
)

FAVOR = shape(sku_id="bigint", create_time="string")
CART = FAVOR
REFUND = shape(
    sku_id="bigint", order_id="bigint", total_amount="amount", create_time="string"
)
COMMENT = shape(sku_id="bigint", appraise="string", create_time="string")

VISITOR_STATS = shape(
    stt="string", edt="string", vc="string", ch="string", ar="string",
    is_new="string", uv_ct="bigint", pv_ct="bigint", sv_ct="bigint",
    uj_ct="bigint", dur_sum="bigint",
)

# What product statistics add up, in output order.
PRODUCT_COUNTS = (
    "click_ct", "display_ct", "favor_ct", "cart_ct", "order_sku_num",
    "comment_ct", "good_comment_ct",
)
PRODUCT_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")
# Output column <- kind of order id it counts.
PRODUCT_ORDER_COUNTS = {
    "order_ct": "order", "paid_order_ct": "paid", "refund_order_ct": "refund",
}

PRODUCT_STATS = T.StructType(
    shape(
        stt="string", edt="string", sku_id="bigint", sku_name="string",
        sku_price="amount", spu_id="bigint", spu_name="string", tm_id="bigint",
        tm_name="string", category3_id="bigint", category3_name="string",
    ).fields
    + [T.StructField(c, T.LongType()) for c in PRODUCT_COUNTS]
    + [T.StructField(c, T.DecimalType(30, 2)) for c in PRODUCT_AMOUNTS]
    + [T.StructField(c, T.LongType()) for c in PRODUCT_ORDER_COUNTS]
)

KEYWORD_STATS = shape(
    stt="string", edt="string", keyword="string", source="string", ct="bigint"
)
