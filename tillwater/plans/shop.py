"""The given tables seen as the shop's topics and dimensions.

Every frame is a plain projection or aggregation of a given table, batch or
streaming; columns the tables lack are computed from ones they have.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwater.functions.times import TIME_FORMAT
from tillwater.operators import measures as m
from tillwater.operators.joins import Dim
from tillwater.operators.wide import order_dims, product_dims

# Stand-in time scales: the tables span days and years, not seconds.
LINE_LOWER, LINE_UPPER = "-100 days", "100 days"
JUMP_WITHIN = "6 hours"
DATABASE = "shop"
ASOF = "2024-01-01 00:00:00"

K = "CAST(get_json_object(props, '$.k') AS INT)"
BRAND = "regexp_extract(p_brand, '([0-9]+)', 1)"
# First letter and length tell the part types apart.
CATEGORY = "CAST(ascii(p_type) * 100 + length(p_type) AS STRING)"


def amount(c: str) -> str:
    return f"CAST({c} AS DECIMAL(20,2))"


def text(ts: str) -> str:
    return f"date_format({ts}, '{TIME_FORMAT}')"


def times(ts: str) -> list[str]:
    """The time as records carry it, and as a timestamp."""
    return [f"{text(ts)} AS create_time", f"{ts} AS et"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shop:
    """Topics and dimensions over one folder of tables.

    `read` turns a table name into a frame; by default a batch read.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str,
        read: Callable[[str], DataFrame] | None = None,
    ):
        self.spark = spark
        # Each table's schema is looked up once.
        self.batch = lru_cache(lambda name: table(spark, sf_dir, name))
        self.read = read or self.batch

    # --- logs ---------------------------------------------------------------

    def logs(self) -> DataFrame:
        """Events as log records, with their id as `tie`."""
        return self.event_records().drop("event_type", "k", "at")

    def event_measures(self) -> DataFrame:
        """Measure rows of all the topics that events stand for, in one pass over them."""
        return m.log_measures(self.event_records(), {
            "event_type = 'view'": m.product_fields("k", "at", favor_ct="1"),
            "event_type = 'purchase'": m.product_fields("k", "at", cart_ct="1"),
            "event_type = 'error'": m.product_fields(
                "k", "at", **m.comment_counts("CAST(1200 + k % 6 AS STRING)")),
        })

    def event_records(self) -> DataFrame:
        """Log records, and beside them the event's type, product and time."""
        events = self.read("events").withColumn("k", F.expr(K))
        return events.selectExpr(
            "event_type", "k", "CAST(ts AS TIMESTAMP) AS at", "event_id AS tie",
            """named_struct(
                'mid', CAST(user_id AS STRING), 'vc', concat('v', k % 4),
                'ch', concat('ch', k % 3), 'ar', CAST(user_id % 25 AS STRING),
                'is_new', IF(event_type = 'signup', '1', '0')
            ) AS common""",
            """IF(event_type <> 'error', named_struct(
                'page_id', CASE event_type WHEN 'signup' THEN 'home' WHEN 'view' THEN 'good_list'
                    WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'payment' END,
                'last_page_id', CASE event_type WHEN 'view' THEN 'home'
                    WHEN 'click' THEN 'good_list' WHEN 'purchase' THEN 'good_detail' END,
                'item', CASE event_type WHEN 'view' THEN concat('Word ', k)
                    WHEN 'click' THEN CAST(k AS STRING) WHEN 'purchase' THEN CAST(k AS STRING) END,
                'item_type', CASE event_type WHEN 'view' THEN 'keyword'
                    WHEN 'click' THEN 'sku_id' WHEN 'purchase' THEN 'sku_id' END,
                'during_time', CAST(round(value * 1000) AS BIGINT)
            ), NULL) AS page""",
            """IF(event_type IN ('signup', 'view'), transform(
                sequence(0, k % 3),
                i -> named_struct(
                    'item', CAST((k + i) % 100 AS STRING),
                    'item_type', IF(i < 2, 'sku_id', 'activity_id')
                )
            ), NULL) AS displays""",
            """IF(event_type = 'error', named_struct(
                'entry', 'icon', 'loading_time', CAST(k AS BIGINT)
            ), NULL) AS start""",
            "unix_millis(CAST(ts AS TIMESTAMP)) AS ts",
        )

    def raw_logs(self) -> DataFrame:
        """The log records as the JSON text a collector would receive."""
        return self.logs().selectExpr(
            "tie", "to_json(struct(common, page, displays, start, ts)) AS value"
        )

    def pages(self, delay: str | None = "3 seconds") -> DataFrame:
        """Page records with visitor and event time; on streams a watermark."""
        timed = self.logs().filter("page IS NOT NULL").selectExpr(
            "*", "common.mid AS mid", "timestamp_millis(ts) AS et"
        )
        return timed.withWatermark("et", delay) if delay and timed.isStreaming else timed

    # --- database topics ----------------------------------------------------

    def order_info(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "o_orderkey AS id", "pmod(o_custkey, 25) AS province_id",
            "o_orderstatus AS order_status", "o_custkey AS user_id",
            f"{amount('o_totalprice')} AS total_amount",
            f"{amount('0')} AS activity_reduce_amount", f"{amount('0')} AS coupon_reduce_amount",
            f"{amount('o_totalprice')} AS original_total_amount", f"{amount('0')} AS feight_fee",
            *times("CAST(o_orderdate AS TIMESTAMP)"),
        )

    def order_detail(self) -> DataFrame:
        price = amount("l_extendedprice")
        return self.read("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS id", "l_orderkey AS order_id",
            "l_partkey AS sku_id", "CAST(l_quantity AS BIGINT) AS sku_num",
            *times("CAST(l_shipdate AS TIMESTAMP)"),
            f"{price} AS split_total_amount",
            f"CAST(round({price} * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(20,2)) "
            "AS split_coupon_amount",
        )

    def payment_info(self) -> DataFrame:
        """One payment per order, 0 to 89 minutes after it."""
        paid = (
            "CAST(o_orderdate AS TIMESTAMP) "
            "+ make_dt_interval(0, 0, CAST(pmod(o_orderkey, 90) AS INT))"
        )
        return self.read("orders").selectExpr(
            "o_orderkey AS id", "o_orderkey AS order_id", "o_custkey AS user_id",
            f"{amount('o_totalprice')} AS total_amount", "'order' AS subject",
            "o_orderpriority AS payment_type", *times(paid),
            f"{text(paid)} AS callback_time",
        )

    def refunds(self) -> DataFrame:
        return self.read("lineitem").filter("l_returnflag = 'R'").selectExpr(
            "l_partkey AS sku_id", "l_orderkey AS order_id",
            f"{amount('l_extendedprice')} AS total_amount",
            *times("CAST(l_shipdate AS TIMESTAMP)"),
        )

    def _event_rows(self, kind: str, *extra: str) -> DataFrame:
        return self.read("events").filter(F.col("event_type") == kind).selectExpr(
            f"CAST({K} AS BIGINT) AS sku_id", *times("CAST(ts AS TIMESTAMP)"), *extra
        )

    def favors(self) -> DataFrame:
        return self._event_rows("view")

    def carts(self) -> DataFrame:
        return self._event_rows("purchase")

    def comments(self) -> DataFrame:
        return self._event_rows("error", f"CAST(1200 + {K} % 6 AS STRING) AS appraise")

    def searches(self) -> DataFrame:
        """Whole documents as search texts, one a second."""
        return self.read("documents").selectExpr(
            "text AS kw", "timestamp_seconds(1704067200 + doc_id) AS et"
        )

    def raw_changes(self) -> DataFrame:
        """Customers and parts as change records in JSON text."""
        operations = ["bootstrap-insert", "insert", "update", "delete", "bootstrap-start"]

        def records(source: DataFrame, topic: str, key: str, **data: Column) -> DataFrame:
            kind = F.element_at(
                F.array(*[F.lit(o) for o in operations]),
                (F.col(key) % len(operations) + 1).cast("int"),
            )
            return source.select(
                F.to_json(F.struct(
                    F.when(F.col(key) % 7 == 6, "other").otherwise(DATABASE).alias("database"),
                    F.lit(topic).alias("table"),
                    kind.alias("type"),
                    F.when(
                        F.col(key) % 11 != 10, F.struct(*[c.alias(n) for n, c in data.items()])
                    ).alias("data"),
                    F.col(key).alias("ts"),
                )).alias("value")
            )

        users = records(
            self.read("customer"), "user_info", "c_custkey",
            id=F.col("c_custkey"), name=F.col("c_name"),
            segment=F.col("c_mktsegment"), nation=F.col("c_nationkey"),
        )
        skus = records(
            self.read("part"), "sku_info", "p_partkey",
            id=F.col("p_partkey"), sku_name=F.col("p_name"), size=F.col("p_size"),
        )
        orders = records(
            self.read("orders"), "order_info", "o_orderkey",
            id=F.col("o_orderkey"), user_id=F.col("o_custkey"),
            status=F.col("o_orderstatus"), priority=F.col("o_orderpriority"),
        )
        return users.unionByName(skus).unionByName(orders)

    def user_changes(self, wave: int) -> DataFrame:
        """Versions of each customer, many within one second, in two waves.

        An insert and an update of the same second come first; then a newer
        update for odd numbers, and for all an older one that comes late.
        """
        key = F.col("c_custkey")

        def change(kind: str, ts: Column, place: int, name: Column, *more: Column) -> Column:
            data = F.struct(key.alias("id"), name.alias("name"), *more)
            return F.struct(
                F.to_json(F.struct(
                    F.lit(DATABASE).alias("database"), F.lit("user_info").alias("table"),
                    F.lit(kind).alias("type"), data.alias("data"), ts.alias("ts"),
                )).alias("value"),
                (key * 10 + place).alias("tie"))

        nation = F.col("c_nationkey").alias("nation")
        waves = {
            1: [change("update", key, 2, F.concat("c_name", F.lit(" 2")), F.lit(-1).alias("nation")),
                change("insert", key, 1, F.col("c_name"), nation)],
            2: [F.when(key % 2 == 1, change("update", key + 1, 3, F.concat("c_name", F.lit(" 3")))),
                change("update", key - 1, 4, F.lit("late"))],
        }
        return self.read("customer").select(
            F.inline(F.array_compact(F.array(*waves[wave]))))

    def routes(self) -> DataFrame:
        """The routing config: two dimensions, one fact, and one unused sink."""
        return self.spark.createDataFrame(
            [
                ("user_info", "insert", "hbase", "dim_user_info", "id,name,nation", "id", None),
                ("user_info", "update", "hbase", "dim_user_info", "id,name,nation", None, None),
                ("sku_info", "insert", "hbase", "dim_sku_info", "id,sku_name", None, None),
                ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,status", None, None),
                ("order_info", "update", "clickhouse", "unused", "id", None, None),
            ],
            "source_table string, operate_type string, sink_type string, sink_table string, "
            "sink_columns string, sink_pk string, sink_extend string",
        )

    # --- dimensions ---------------------------------------------------------

    def users(self) -> DataFrame:
        """Customers with a birthday computed from their number."""
        return self.batch("customer").selectExpr(
            "CAST(c_custkey AS STRING) AS ID", "c_mktsegment AS GENDER",
            "CAST(date_add(DATE '1960-01-01', CAST(c_custkey * 37 % 15000 AS INT)) AS STRING) "
            "AS BIRTHDAY",
        )

    def provinces(self) -> DataFrame:
        return self.batch("nation").selectExpr(
            "CAST(n_nationkey AS STRING) AS ID", "n_name AS NAME",
            "concat('R', n_regionkey) AS AREA_CODE", "concat('I', n_nationkey) AS ISO_CODE",
            "concat('N-', n_nationkey) AS ISO_3166_2",
        )

    def skus(self) -> DataFrame:
        return self.batch("part").selectExpr(
            "CAST(p_partkey AS STRING) AS ID", "p_name AS SKU_NAME",
            "CAST(p_retailprice AS STRING) AS PRICE", "CAST(p_size AS STRING) AS SPU_ID",
            f"{BRAND} AS TM_ID", f"{CATEGORY} AS CATEGORY3_ID",
        )

    def spus(self) -> DataFrame:
        return self.batch("part").selectExpr(
            "CAST(p_size AS STRING) AS ID", "concat('size ', p_size) AS SPU_NAME"
        ).distinct()

    def trademarks(self) -> DataFrame:
        return self.batch("part").selectExpr(f"{BRAND} AS ID", "p_brand AS TM_NAME").distinct()

    def categories(self) -> DataFrame:
        return self.batch("part").selectExpr(f"{CATEGORY} AS ID", "p_type AS NAME").distinct()

    def product_dims(self, *levels: str) -> list[Dim]:
        """The product lookup with the named levels above the sku; all by default."""
        tables = {"spu": self.spus, "trademark": self.trademarks, "category3": self.categories}
        wanted = levels or tuple(tables)
        return product_dims(self.skus(), **{n: tables[n]() for n in wanted})

    def sku_dim(self) -> list[Dim]:
        return product_dims(self.skus())

    def order_dims(self) -> list[Dim]:
        return order_dims(
            self.users(), self.provinces(), self.skus(), self.spus(),
            self.trademarks(), self.categories(), F.lit(ASOF).cast("timestamp"),
        )
