"""Order and payment wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwater.functions import (
    age_years, date_part, event_time, hour_part, timestamp_to_millis,
)
from tillwater.operators.joins import Dim, interval_join

# Columns each side of the order join brings along.
_FROM_ORDER = (
    "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "create_time",
)
_FROM_DETAIL = (
    "sku_id", "sku_name", "sku_num", "split_activity_amount",
    "split_coupon_amount", "split_total_amount",
)
# Columns only the payment decides; the order's values are overwritten.
_FROM_PAYMENT = (
    "order_id", "user_id", "total_amount", "subject", "payment_type", "callback_time",
)


def _timed(df: DataFrame, prefix: str, delay: str) -> DataFrame:
    """Prefix all columns and add the event time, `et`."""
    timed = df.withColumn("et", F.expr(event_time(df, "create_time")))
    if df.isStreaming:
        timed = timed.withWatermark("et", delay)
    return timed.toDF(*[prefix + c for c in timed.columns])


def order_wide(
    orders: DataFrame, details: DataFrame, lower: str = "-10 seconds",
    upper: str = "10 seconds", delay: str = "5 seconds", slice: str | None = None,
) -> DataFrame:
    """Each order line with its order, when their times lie close together.

    The line's price and the order's expire and operate times are not taken
    over; prices come from the sku dimension.
    """
    pairs = interval_join(
        _timed(orders, "o_", delay), _timed(details, "d_", delay),
        "o_id", "d_order_id", "o_et", "d_et", lower, upper, slice,
    )
    have_o = {c for c in _FROM_ORDER if f"o_{c}" in pairs.columns}
    have_d = {c for c in _FROM_DETAIL if f"d_{c}" in pairs.columns}
    return pairs.select(
        F.col("d_id").alias("detail_id"),
        F.col("o_id").alias("order_id"),
        *[F.col(f"d_{c}").alias(c) for c in _FROM_DETAIL if c in have_d],
        *[F.col(f"o_{c}").alias(c) for c in _FROM_ORDER if c in have_o],
        date_part("o_create_time").alias("create_date"),
        hour_part("o_create_time").alias("create_hour"),
        timestamp_to_millis("o_et").alias("ts"),
    )


def payment_wide(
    payments: DataFrame, wide: DataFrame, lower: str = "-45 minutes",
    upper: str = "5 seconds", delay: str = "3 seconds", slice: str | None = None,
) -> DataFrame:
    """Each payment with the order lines created shortly before it.

    The payment is applied last, so its order, user and total amount win.
    """
    pairs = interval_join(
        _timed(payments, "p_", delay), _timed(wide, "w_", delay),
        "p_order_id", "w_order_id", "p_et", "w_et", lower, upper, slice,
    )
    paid = [c for c in _FROM_PAYMENT if f"p_{c}" in pairs.columns]
    dropped = {*paid, "create_time", "create_date", "create_hour", "ts"}
    kept = [c for c in wide.columns if c not in dropped]
    return pairs.select(
        F.col("p_id").alias("payment_id"),
        F.col("p_create_time").alias("payment_create_time"),
        F.col("w_create_time").alias("order_create_time"),
        *[F.col(f"p_{c}").alias(c) for c in paid],
        *[F.col(f"w_{c}").alias(c) for c in kept],
        timestamp_to_millis("p_et").alias("ts"),
    )


def order_dims(
    user: DataFrame, province: DataFrame, sku: DataFrame, spu: DataFrame,
    trademark: DataFrame, category3: DataFrame, asof,
) -> list[Dim]:
    """The lookups of the order wide table: user, province and product."""
    return [
        Dim("user", user, "user_id", {
            "user_gender": "GENDER",
            "user_age": age_years("BIRTHDAY", asof),
        }),
        Dim("province", province, "province_id", {
            "province_name": "NAME",
            "province_3166_2_code": "ISO_3166_2",
            "province_area_code": "AREA_CODE",
            "province_iso_code": "ISO_CODE",
        }),
        *product_dims(sku, spu, trademark, category3),
    ]


def product_dims(
    sku: DataFrame, spu: DataFrame | None = None, trademark: DataFrame | None = None,
    category3: DataFrame | None = None,
) -> list[Dim]:
    """The lookup of a product: its sku, and through it spu, trademark, category.

    Only the levels that are wanted need be given; None leaves one out.
    """
    levels = (
        ("spu", spu, "spu_id", {"spu_name": "SPU_NAME"}),
        ("trademark", trademark, "tm_id", {"tm_name": "TM_NAME"}),
        ("category3", category3, "category3_id", {"category3_name": "NAME"}),
    )
    return [
        Dim(
            "sku", sku, "sku_id",
            {
                "sku_name": "SKU_NAME",
                "sku_price": F.col("PRICE").cast("decimal(20,2)"),
                "spu_id": F.col("SPU_ID").cast("bigint"),
                "tm_id": F.col("TM_ID").cast("bigint"),
                "category3_id": F.col("CATEGORY3_ID").cast("bigint"),
            },
            then=tuple(Dim(*level) for level in levels if level[1] is not None),
        )
    ]
