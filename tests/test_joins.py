"""Interval joins, wide tables and lookups."""

import datetime as dt
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from tillwater.operators.joins import Dim, enrich, interval_join, split_missing
from tillwater.operators.wide import order_dims, order_wide, payment_wide
from tillwater.schemas import ORDER_DETAIL, ORDER_INFO, PAYMENT_INFO

NOON = dt.datetime(2022, 4, 1, 12)


def clock(seconds=0):
    return (NOON + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def table(spark, schema, *records):
    return spark.createDataFrame(
        [tuple(r.get(n) for n in schema.names) for r in records], schema
    )


def order(spark, **over):
    base = dict(id=1, province_id=7, user_id=5, order_status="1001", create_time=clock())
    return table(spark, ORDER_INFO, {**base, **over})


def test_lines_within_ten_seconds_of_their_order(spark):
    details = table(
        spark, ORDER_DETAIL,
        *[dict(id=100 + s, order_id=1, sku_id=3, create_time=clock(s)) for s in (-11, -10, 0, 10, 11)],
        dict(id=999, order_id=2, sku_id=3, create_time=clock()),
    )
    wide = order_wide(order(spark), details)
    assert rows(wide, "detail_id") == [(100,), (110,), (90,)]
    one = wide.first()
    assert (one.create_date, one.create_hour) == ("2022-04-01", "12")
    assert one.ts == int(NOON.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    # Prices and the order's other times come from elsewhere.
    assert not {"sku_price", "expire_time", "operate_time", "split_feight_fee"} & set(wide.columns)


def test_payments_up_to_45_minutes_after_the_order(spark):
    details = table(spark, ORDER_DETAIL, dict(id=100, order_id=1, sku_id=3, create_time=clock()))
    wide = order_wide(order(spark), details)
    # Seconds from the order to the payment.
    lags = [-6, -5, 0, 45 * 60, 45 * 60 + 1]
    payments = table(spark, PAYMENT_INFO, *[
        dict(id=i, order_id=1, user_id=50, total_amount=Decimal(9), create_time=clock(lag))
        for i, lag in enumerate(lags)
    ])
    paid = payment_wide(payments, wide)
    assert rows(paid, "payment_id") == [(1,), (2,), (3,)]
    one = paid.filter("payment_id = 2").first()
    assert one.user_id == 50 and float(one.total_amount) == 9
    assert one.order_create_time == one.payment_create_time == clock()


def test_slices_find_each_pair_once(spark):
    left = spark.range(60).select(
        (F.col("id") % 3).alias("a"), F.timestamp_millis(F.col("id") * 1700).alias("at"), F.col("id").alias("l")
    )
    right = spark.range(60).select(
        (F.col("id") % 3).alias("b"), F.timestamp_millis(F.col("id") * 1300).alias("bt"), F.col("id").alias("r")
    )
    want = rows(left.join(right, F.expr(
        "a = b AND bt BETWEEN at - INTERVAL 4 SECONDS AND at + INTERVAL 9 SECONDS"
    )), "l", "r")
    for slice in ("1 second", "3 seconds", "13 seconds", "1 hour", None):
        got = interval_join(left, right, "a", "b", "at", "bt", "-4 seconds", "9 seconds", slice)
        assert rows(got, "l", "r") == want


def test_tables_bucketed_by_the_key_join_without_a_shuffle(spark, folder):
    names = []
    for i, (key, at) in enumerate((("a", "at"), ("b", "bt"))):
        name = f"bucketed_{uuid.uuid4().hex}"
        frame = spark.range(50).select(
            F.col("id").alias(key), F.timestamp_millis("id").alias(at))
        frame.write.bucketBy(4, key).option("path", f"{folder}/{i}").saveAsTable(name)
        names.append(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = interval_join(
            *map(spark.table, names), "a", "b", "at", "bt", "-4 seconds", "9 seconds")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"DROP TABLE {name}")


def test_the_slice_is_part_of_the_shuffle(spark):
    left = spark.range(5).select(F.col("id").alias("a"), F.timestamp_millis("id").alias("at"))
    right = left.toDF("b", "bt")
    joined = interval_join(left, right, "a", "b", "at", "bt", "-4 seconds", "9 seconds", "1 minute")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [l for l in text.splitlines() if "hashpartitioning(" in l]
    assert len(shuffles) == 2 and all("_slice" in l for l in shuffles)


def dims(spark):
    one = lambda schema, *values: spark.createDataFrame([values], schema)
    return order_dims(
        one("ID string, GENDER string, BIRTHDAY string", "5", "F", "2000-01-01"),
        one("ID string, NAME string, ISO_3166_2 string, AREA_CODE string, ISO_CODE string",
            "7", "North", "X-N", "70", "N7"),
        one("ID string, SKU_NAME string, PRICE string, SPU_ID string, TM_ID string, CATEGORY3_ID string",
            "3", "Phone", "12.5", "30", "31", "32"),
        one("ID string, SPU_NAME string", "30", "Phones"),
        one("ID string, TM_NAME string", "31", "Brand"),
        one("ID string, NAME string", "32", "Electronics"),
        F.lit(dt.datetime(2022, 1, 1)),
    )


def test_six_lookups(spark):
    details = table(
        spark, ORDER_DETAIL, dict(id=100, order_id=1, sku_id=3, sku_name="old", create_time=clock())
    )
    one = enrich(order_wide(order(spark), details), dims(spark)).first()
    assert (one.user_gender, one.user_age) == ("F", 22)
    assert (one.province_name, one.province_area_code) == ("North", "70")
    assert (one.sku_name, float(one.sku_price), one.spu_name) == ("Phone", 12.5, "Phones")
    assert (one.tm_id, one.tm_name, one.category3_name) == (31, "Brand", "Electronics")


def test_missing_lookups_keep_the_row_and_are_listed(spark):
    facts = spark.createDataFrame([(1, 3), (1, 4)], "user_id long, sku_id long")
    wanted = [d for d in dims(spark) if d.name in ("user", "sku")]
    marked = enrich(facts, wanted, mark_missing=True)
    complete, missing = split_missing(marked)
    assert complete.count() == 0 and marked.count() == 2
    # What hangs on a missing sku is missing too.
    assert rows(missing, "sku_id", F.array_join("missing_dims", ",")) == [
        (3, "user"), (4, "user,sku,spu,trademark,category3")
    ]
    assert "spu_name" in missing.columns


def test_facts_are_joined_once_per_product_lookup(spark):
    facts = spark.createDataFrame([(1, 3)], "user_id long, sku_id long")
    product = [d for d in dims(spark) if d.name == "sku"]
    logical = enrich(facts, product)._jdf.queryExecution().optimizedPlan()
    assert logical.toString().count("Join LeftOuter") == 4
    top = [l for l in logical.toString().splitlines() if "Join LeftOuter" in l]
    assert "sku_id" in top[0]


def test_spreading_a_lookup_changes_nothing(spark):
    facts = spark.range(300).select((F.col("id") % 4).alias("k"), "id")
    names = spark.createDataFrame([("0", "a"), ("1", "b"), ("2", "c")], "ID string, N string")
    plain = enrich(facts, [Dim("n", names, "k", {"name": "N"})])
    spread = enrich(facts, [Dim("n", names, "k", {"name": "N"}, spread=5)])
    assert rows(spread, "id", "name") == rows(plain, "id", "name")


def test_adaptive_execution_splits_a_hot_key(spark):
    """A key with a third of the rows, and a table that may not be broadcast."""
    facts = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    names = spark.range(0, 300_000, 1, 4).select(F.col("id").cast("string").alias("ID"), F.lit("n").alias("N"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        named = enrich(facts, [Dim("n", names, "k", {"name": "N"})])
        got = named.filter(F.length("payload") > 0).select("k", "name", "payload")
        assert len(got.collect()) == 300_000
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in text or "isSkew=true" in text or "(skew=true)" in text
    finally:
        for key in settings:
            spark.conf.unset(key)
