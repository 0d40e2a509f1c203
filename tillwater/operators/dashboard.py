"""Dashboard queries over the serving tables.

With a date they answer for that day, 0 and "today" included. Without one they
answer for every day at once and carry the day in column `dt`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwater.functions import date_part, day_range, hour_part, source_weight
from tillwater.operators.joins import enrich

EVERY_DAY = object()
HOURS = 24


def _daily(stats: DataFrame, date) -> tuple[DataFrame, list[str]]:
    if date is EVERY_DAY:
        return stats.withColumn("dt", date_part("stt")), ["dt"]
    return stats.filter(day_range("stt", date)), []


def gmv_day(stats: DataFrame, date=EVERY_DAY) -> DataFrame:
    """Total order amount."""
    return gmv_by(stats, [], date)


def gmv_by(stats: DataFrame, keys: list[str], date=EVERY_DAY, orders: bool = False) -> DataFrame:
    """Order amount, on request with the order count, by brand, category or spu."""
    rows, day = _daily(stats, date)
    sums = [F.sum("order_amount").alias("order_amount")]
    if orders:
        sums.append(F.sum("order_ct").alias("order_ct"))
    return rows.groupBy(*day, *keys).agg(*sums)


def product_days(stats: DataFrame, dims: list, orders: bool = False) -> DataFrame:
    """Product statistics summed per sku and day, then named.

    Summing before the lookups keeps their input at one row per sku and day.
    """
    sums = [F.sum("order_amount").alias("order_amount")]
    if orders:
        sums.append(F.sum("order_ct").alias("order_ct"))
    midnight = F.concat(date_part("stt"), F.lit(" 00:00:00"))
    per_sku = stats.groupBy(midnight.alias("stt"), "sku_id").agg(*sums)
    return enrich(per_sku, dims)


def province_amount(stats: DataFrame, date=EVERY_DAY) -> DataFrame:
    rows, day = _daily(stats, date)
    return rows.groupBy(*day, "province_name").agg(
        F.sum("order_amount").alias("order_amount"),
        F.sum("order_count").alias("order_count"),
    )


def visitors_by_hour(stats: DataFrame, date=EVERY_DAY) -> DataFrame:
    """Views, visitors and jumps of all 24 hours; hours without any are zero."""
    rows, day = _daily(stats, date)
    names = {"pv": "pv_ct", "uv": "uv_ct", "uj": "uj_ct"}
    hourly = rows.groupBy(*day, hour_part("stt").cast("int").alias("hour")).agg(
        *[F.sum(c).alias(n) for n, c in names.items()]
    )
    filled = [F.coalesce(n, F.lit(0)).alias(n) for n in names]
    if date is not EVERY_DAY:
        hours = rows.sparkSession.range(HOURS).select(F.col("id").cast("int").alias("hour"))
        return hours.join(hourly, "hour", "left").select("hour", *filled)
    # At most 24 entries per day, so each day fits in one row.
    by_day = hourly.groupBy(*day).agg(
        F.map_from_entries(
            F.collect_list(F.struct("hour", F.struct(*names)))
        ).alias("_seen")
    )
    dense = by_day.select(
        *day, "_seen", F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))).alias("hour")
    )
    return dense.select(
        *day, "hour",
        *[
            F.coalesce(F.try_element_at("_seen", F.col("hour"))[n], F.lit(0)).alias(n)
            for n in names
        ],
    )


def keyword_score(stats: DataFrame, date=EVERY_DAY) -> DataFrame:
    """Occurrences weighted by where the word was seen."""
    rows, day = _daily(stats, date)
    return rows.groupBy(*day, "keyword").agg(
        F.sum(F.col("ct") * source_weight("source")).alias("score")
    )
