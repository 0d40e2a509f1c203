"""Windowed statistics and dashboard queries on hand-made rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF, rows
from tillwater import schemas
from tillwater.operators import dashboard as dash, measures as m, stats
from tillwater.operators.parsing import parse_json
from tillwater.sources import literal_records
from tillwater.sinks import file_sink
from tillwater.sources import file_stream
from tillwater.streaming.runner import start


def page(mid="1", ts=1_000, last=None, item=None, item_type=None, during=10, page_id="home"):
    return {
        "common": {"mid": mid, "vc": "v1", "ch": "c", "ar": "a", "is_new": "1"},
        "page": {"page_id": page_id, "last_page_id": last, "item": item,
                 "item_type": item_type, "during_time": during},
        "ts": ts,
    }


def logs(spark, *records):
    return parse_json(literal_records(spark, list(records)), schemas.LOG)[0]


def test_visitor_measures_add_up(spark):
    pages = logs(spark, page(ts=0), page(ts=4_999, last="home", during=None), page(ts=5_000, last="home"))
    uv = uj = logs(spark, page(ts=0))
    got = stats.visitor_stats(pages, uv, uj)
    assert rows(got, "stt", "edt", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum") == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:05", 1, 2, 1, 1, 10),
        ("1970-01-01 00:00:05", "1970-01-01 00:00:10", 0, 1, 0, 0, 10),
    ]


def test_underscores_do_not_mix_keys(spark):
    one, two = page(), page()
    one["common"].update(vc="a_b", ch="c")
    two["common"].update(vc="a", ch="b_c")
    pages = logs(spark, one, two)
    none = pages.filter("false")
    assert stats.visitor_stats(pages, none, none).count() == 2


def test_product_statistics(spark):
    pages = logs(spark, page(item="7", item_type="sku_id"), page(item="x", item_type="keyword"))
    wide = spark.createDataFrame(
        [(7, 1, 2, Decimal("1.10"), 1_000), (7, 1, 1, Decimal("2.20"), 2_000), (7, 2, 1, None, 3_000)],
        "sku_id long, order_id long, sku_num long, split_total_amount decimal(20,2), ts long",
    )
    refund = spark.createDataFrame(
        [(7, 1, Decimal("5.00"), "1970-01-01 00:00:01")], schemas.REFUND
    )
    comment = spark.createDataFrame(
        [(7, a, "1970-01-01 00:00:04") for a in ("1201", "1204", "1205", None)], schemas.COMMENT
    )
    rows_ = [m.clicks(pages), m.orders(wide), m.payments(wide), m.refunds(refund), m.comments(comment)]
    one = stats.product_stats(rows_).collect()
    assert len(one) == 1
    got = one[0]
    assert (got.click_ct, got.order_sku_num, got.comment_ct, got.good_comment_ct) == (1, 4, 4, 2)
    assert (got.order_ct, got.paid_order_ct, got.refund_order_ct) == (2, 2, 1)
    assert (got.order_amount, got.refund_amount) == (Decimal("3.30"), Decimal("5.00"))


def test_orders_are_counted_without_collecting_them(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    wide = lines.select(
        F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").cast("long").alias("sku_num"),
        F.col("l_extendedprice").cast("decimal(20,2)").alias("split_total_amount"),
        F.col("l_shipdate").cast("timestamp").alias("et"),
    )
    text = stats.product_stats([m.orders(wide)])._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in text and "Expand" not in text
    shuffles = [l for l in text.splitlines() if "hashpartitioning(" in l]
    assert len(shuffles) == 2 and any("order_id" in l for l in shuffles)


def test_province_statistics(spark):
    wide = spark.createDataFrame(
        [(1, "N", "70", "N1", "X-N", Decimal(10), 5, "2022-04-01 10:00:01"),
         (1, "N", "70", "N1", "X-N", Decimal(20), 5, "2022-04-01 10:00:04"),
         (1, "N", "70", "N1", "X-N", Decimal(1), 6, "2022-04-01 10:00:05")],
        "province_id long, province_name string, province_area_code string, province_iso_code string, "
        "province_3166_2_code string, split_total_amount decimal(20,2), order_id long, create_time string",
    )
    got = rows(stats.province_stats(wide), "stt", "area_code", "iso_code", "order_amount", "order_count")
    assert got == [
        ("2022-04-01 10:00:00", "70", "N1", Decimal("30.00"), 1),
        ("2022-04-01 10:00:05", "70", "N1", Decimal("1.00"), 1),
    ]


def test_search_words_per_window(spark):
    pages = logs(
        spark, page(page_id="good_list", item_type="keyword", item="red phone red"),
        page(page_id="good_list", item_type="keyword", item="Phone", ts=4_000),
        page(page_id="good_list", item_type="keyword"), page(item="red", item_type="keyword"),
    )
    got = stats.search_keywords(m.searches(pages), tz="Asia/Shanghai")
    assert rows(got, "stt", "keyword", "source", "ct") == [
        ("1970-01-01 08:00:00", "phone", "search", 2), ("1970-01-01 08:00:00", "red", "search", 1),
    ]
    as_map = pages.withColumn("page", F.map_from_entries(F.array(*[
        F.struct(F.lit(n).alias("k"), F.col(f"page.{n}").alias("v")) for n in ("page_id", "item_type", "item")
    ])))
    assert m.searches(as_map).count() == 2


def test_product_words(spark):
    table = spark.createDataFrame(
        [("1970-01-01 00:00:00", "1970-01-01 00:00:05", "red phone", 1, 0, 3),
         ("1970-01-01 00:00:00", "1970-01-01 00:00:05", "red case", 2, 0, 0),
         ("1970-01-01 00:00:00", "1970-01-01 00:00:05", "idle", 0, 0, 0)],
        "stt string, edt string, sku_name string, click_ct long, cart_ct long, order_ct long",
    )
    got = rows(stats.product_keywords(table), "keyword", "source", "ct")
    assert got == [
        ("case", "click", 2), ("phone", "click", 1), ("phone", "order", 3),
        ("red", "click", 3), ("red", "order", 3),
    ]


def test_words_may_come_from_elsewhere(spark):
    import pandas as pd

    @F.pandas_udf("array<string>")
    def halves(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [t[: len(t) // 2], t[len(t) // 2:]])

    texts = spark.createDataFrame([("redphone",)], "kw string").withColumn("et", F.timestamp_millis(F.lit(0)))
    assert rows(stats.search_keywords(texts, words=halves), "keyword") == [("hone",), ("redp",)]
    assert rows(stats.search_keywords(texts, words=halves), "ct") == [(1,), (1,)]


def test_sql_functions_agree_with_the_columns(spark):
    from tillwater import functions as fn
    from tillwater.functions.sql import register

    register(spark)
    texts = spark.createDataFrame(
        [("Red phone, red 4G", 1, 0, 3, "cart"), ("", None, 2, 0, "order")],
        "txt string, a long, b long, c long, s string",
    )
    named = texts.selectExpr(
        "split_words(txt) AS w", "positive_sources(a, b, c) AS p", "source_weight(s) AS v"
    )
    columns = texts.select(fn.tokenize("txt"), fn.positive_sources("a", "b", "c"), fn.source_weight("s"))
    assert rows(named) == rows(columns)
    query = spark.sql(
        "SELECT word, ct FROM (SELECT split_words(txt) AS w, positive_sources(a, b, c) AS p FROM {t}) "
        "LATERAL VIEW explode(w) g AS word LATERAL VIEW inline(p) h AS source, ct", t=texts,
    )
    assert query.count() == 6
    assert "Join" not in query._jdf.queryExecution().optimizedPlan().toString()


def serving(spark):
    return spark.createDataFrame(
        [("2022-04-01 00:00:00", 1, "b1", Decimal(5), 1), ("2022-04-01 23:59:55", 1, "b1", Decimal(6), 2),
         ("2022-04-02 00:00:00", 2, "b2", Decimal(7), 3)],
        "stt string, tm_id long, tm_name string, order_amount decimal(20,2), order_ct long",
    )


def test_amounts_of_a_day_and_of_every_day(spark):
    table = serving(spark)
    assert rows(dash.gmv_day(table, 20220401)) == [(Decimal("11.00"),)]
    assert dash.gmv_day(table).count() == 2
    assert rows(dash.gmv_by(table, ["tm_id", "tm_name"], "2022-04-02", orders=True)) == [
        (2, "b2", Decimal("7.00"), 3)
    ]
    assert dash.gmv_by(table, ["tm_name"]).columns == ["dt", "tm_name", "order_amount"]
    # Nothing today: one empty sum, as in SQL.
    assert rows(dash.gmv_day(table, 0)) == [(None,)]


def test_all_hours_are_there(spark):
    table = spark.createDataFrame(
        [("2022-04-01 03:00:00", 1, 2, 3), ("2022-04-01 03:30:00", 1, 2, 3)],
        "stt string, pv_ct long, uv_ct long, uj_ct long",
    )
    one_day = dash.visitors_by_hour(table, 20220401)
    assert one_day.count() == 24 and rows(one_day.filter("hour = 3"), "pv", "uv", "uj") == [(2, 4, 6)]
    assert rows(dash.visitors_by_hour(table, 20300101).agg(F.sum("pv"), F.count("*"))) == [(0, 24)]
    every = dash.visitors_by_hour(table)
    assert every.count() == 24 and rows(every.filter("hour = 4"), "dt", "pv") == [("2022-04-01", 0)]


def test_keyword_score(spark):
    table = spark.createDataFrame(
        [("2022-04-01 00:00:00", "w", s, 1) for s in ("search", "click", "cart", "order")],
        "stt string, keyword string, source string, ct long",
    )
    assert rows(dash.keyword_score(table, 20220401)) == [("w", 20)]


def test_a_day_reaches_the_scan(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_shipdate").alias("stt"), F.col("l_extendedprice").alias("order_amount")
    )
    text = dash.gmv_day(lines, dt.date(1998, 6, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "ReadSchema: struct<l_extendedprice:double,l_shipdate:timestamp_ntz>" in text


def test_distinct_orders_over_windows(spark, folder):
    """An order in two windows, or of two products, counts once; batch as on a stream."""
    data = [(1, 7, 1), (1, 7, 2), (1, 8, 9), (32_768, 7, 3), (32_769, 7, 8), (-5, 7, 8),
            (None, 7, 8), (40_000, 9, 9)]
    lines = spark.createDataFrame(data, "order_id long, sku_id long, s long").withColumn(
        "et", F.timestamp_seconds("s"))
    bits = stats.order_bits(lines, ["sku_id"])
    assert rows(stats.distinct_orders(bits, ["sku_id"])) == [(7, 4), (8, 1), (9, 1)]
    assert rows(stats.distinct_orders(bits, ["stt"])) == [
        ("1970-01-01 00:00:00", 2), ("1970-01-01 00:00:05", 4)]
    far = spark.createDataFrame([(9, 9, 10**9)], "order_id long, sku_id long, s long")
    lines.drop("et").unionByName(far).write.parquet(f"{folder}/in")
    stream = file_stream(spark, f"{folder}/in", far.schema).withColumn(
        "et", F.timestamp_seconds("s"))
    start(
        spark, file_sink(stats.order_bits(stream, ["sku_id"]), f"{folder}/out"),
        f"{folder}/checkpoint", drain=True, state_partitions=2).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/out").select(*bits.columns)) == rows(bits)
