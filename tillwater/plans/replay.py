"""The streaming queries, run over everything the tables hold.

Each table is a file stream, followed by one far-future row that moves the
watermark past the last real record. Its own window or match stays open, so it
never shows up in a result. Stages that follow one another are queries of their
own with a folder in between, as they would be with topics.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwater import schemas
from tillwater.operators import measures as m, stats
from tillwater.operators.joins import Dim, enrich
from tillwater.operators.jumps import TIMEOUT_ONLY, user_jump
from tillwater.operators.logs import flatten_displays
from tillwater.operators.parsing import parse_json
from tillwater.operators.wide import order_wide, payment_wide
from tillwater.plans import layers
from tillwater.plans.queries import (
    DAY, HOUR, data_text, page_fields, plain,
)
from tillwater.plans.shop import DATABASE, JUMP_WITHIN, LINE_LOWER, LINE_UPPER, Shop
from tillwater.session import scratch_dir, tune
from tillwater.sinks import (
    compact_dim, enriching_sink, hidden, landing_sink, routing_sink, serving_sink,
)
from tillwater.sources import file_stream, read_dim, read_serving
from tillwater.streaming.firsts import daily_unique_stream, flag_new_visitors_stream
from tillwater.streaming.runner import drain_to_folder, start, start_split

FAR = dt.datetime(2200, 1, 1)
FAR_TEXT = "2200-01-01 00:00:00"
FAR_MILLIS = int(FAR.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)

# The closing rows of each table. Orders and lines differ in their order. Each
# kind of event is an input of its own somewhere, with a watermark of its own.
CLOSING = {
    "events": [
        dict(event_id=-1 - i, ts=FAR, user_id=-1, event_type=kind, value=0.0, props='{"k": 0}')
        for i, kind in enumerate(("signup", "view", "click", "purchase", "error"))
    ],
    "orders": [dict(o_orderkey=-1, o_custkey=-1, o_totalprice=0.0, o_orderdate=FAR)],
    "lineitem": [dict(
        l_orderkey=-2, l_linenumber=0, l_extendedprice=0.0, l_discount=0.0, l_quantity=0.0,
        l_shipdate=FAR, l_returnflag="R",
    )],
    "documents": [dict(doc_id=5_000_000_000, text="")],
}
# The closing row of a topic that only carries a time.
LATER = dict(ts=FAR_MILLIS, et=FAR, tie=-9)


def followed_by(
    spark: SparkSession, stream: DataFrame, schema: T.StructType, rows: list[dict]
) -> DataFrame:
    """The stream and its closing rows."""
    folder = scratch_dir(spark, "closing")
    values = [tuple(row.get(f.name) for f in schema.fields) for row in rows]
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    spark.createDataFrame(values, loose).coalesce(1).write.parquet(folder)
    return stream.unionByName(file_stream(spark, folder, loose))


class StreamShop(Shop):
    """The shop's topics as streams over one folder of tables.

    Stages without windows or matches need no closing rows.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, closing: bool = True):
        super().__init__(tune(spark), sf_dir, self._stream)
        self.sf_dir = sf_dir
        self.closing = CLOSING if closing else {}

    def _stream(self, name: str) -> DataFrame:
        schema = self.batch(name).schema
        # A pattern, since a file stream takes a plain path for a folder, and
        # a table may be either.
        body = file_stream(self.spark, f"{self.sf_dir}/{name}.parque[t]", schema)
        if name not in self.closing:
            return body
        return followed_by(self.spark, body, schema, self.closing[name])

    def drain(self, df: DataFrame, purpose: str, **options) -> DataFrame:
        folder = drain_to_folder(self.spark, df, purpose, **options)
        return self.spark.read.schema(df.schema).parquet(folder)

    def topic(
        self, df: DataFrame, purpose: str, closing: dict | None = None, **options,
    ) -> DataFrame:
        """Run a stage into a folder and read that folder as a stream."""
        folder = drain_to_folder(self.spark, df, purpose, **options)
        stream = file_stream(self.spark, folder, df.schema)
        return followed_by(self.spark, stream, df.schema, [closing]) if closing else stream

    # --- stages -------------------------------------------------------------

    def wide(self) -> DataFrame:
        return order_wide(self.order_info(), self.order_detail(), LINE_LOWER, LINE_UPPER)

    def wide_topic(self) -> DataFrame:
        return self.topic(
            self.wide(), "order_wide", dict(order_id=-3, create_time=FAR_TEXT, ts=FAR_MILLIS),
            settle=False,
        )

    def paid(self, wide: DataFrame) -> DataFrame:
        return payment_wide(self.payment_info(), wide)

    def jumps(self, mode: str) -> DataFrame:
        return user_jump(self.pages(), "mid", "et", m.is_entry(), "tie", JUMP_WITHIN, mode)

    def uniques(self) -> DataFrame:
        return daily_unique_stream(self.pages(), "mid", "et", "tie")


def new_visitor_flag_stream(spark, sf_dir):
    s = StreamShop(spark, sf_dir)
    flagged = flag_new_visitors_stream(s.pages(), "mid", "et", "tie")
    return s.drain(flagged.select(*page_fields(flagged), "is_new"), "new_visitors")


def daily_unique_visitor_stream(spark, sf_dir):
    s = StreamShop(spark, sf_dir)
    uv = s.uniques()
    return s.drain(uv.select(*page_fields(uv)), "unique_visitors")


def user_jump_stream(spark, sf_dir, mode="entry_or_timeout"):
    s = StreamShop(spark, sf_dir)
    uj = s.jumps(mode)
    return s.drain(uj.select(*page_fields(uj)), "jumps")


def user_jump_timeout_only_stream(spark, sf_dir):
    return user_jump_stream(spark, sf_dir, TIMEOUT_ONLY)


def order_wide_interval_stream(spark, sf_dir):
    s = StreamShop(spark, sf_dir)
    return plain(s.drain(s.wide(), "order_wide", settle=False))


def payment_wide_interval_stream(spark, sf_dir):
    s = StreamShop(spark, sf_dir)
    return plain(s.drain(s.paid(s.wide_topic()), "payment_wide", settle=False))


def dim_enrich_stream(spark, sf_dir):
    """Two interval-joined streams with the six lookups, in one query."""
    s = StreamShop(spark, sf_dir)
    return plain(s.drain(enrich(s.wide(), s.order_dims()), "enriched", settle=False).select(
        "detail_id", "order_id", "sku_id", "create_time", "split_total_amount",
        "user_gender", "user_age", "province_name", "province_3166_2_code",
        "province_area_code", "province_iso_code", "sku_name", "sku_price",
        "spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name",
    ))


def visitor_stats_stream(spark, sf_dir):
    """Three topics: pages, unique visitors and jumps."""
    s = StreamShop(spark, sf_dir)
    uv = s.topic(s.uniques(), "unique_visitors", LATER)
    uj = s.topic(s.jumps("entry_or_timeout"), "jumps", LATER)
    pages = s.pages(delay=None)
    return s.drain(stats.visitor_stats(pages, uv, uj, HOUR), "visitor_stats")


def _product_totals(s: StreamShop) -> DataFrame:
    wide = s.wide_topic()
    paid = s.topic(
        s.paid(wide), "payment_wide", dict(order_id=-3, ts=FAR_MILLIS), settle=False)
    rows = layers.product_rows(
        page=s.pages(delay=None), display=flatten_displays(s.logs()), favor=s.favors(),
        cart=s.carts(), order_wide=wide, payment_wide=paid, refund=s.refunds(),
        comment=s.comments(),
    )
    return enrich(stats.product_stats(rows, DAY), s.product_dims())


def product_stats_stream(spark, sf_dir):
    """Eight topics into one windowed statistic, then the lookups."""
    s = StreamShop(spark, sf_dir)
    return plain(s.drain(_product_totals(s), "product_stats"))


def province_stats_stream(spark, sf_dir):
    s = StreamShop(spark, sf_dir)
    named = enrich(s.wide_topic(), [d for d in s.order_dims() if d.name == "province"])
    return plain(s.drain(stats.province_stats(named, DAY), "province_stats"))


def search_keyword_count_stream(spark, sf_dir):
    s = StreamShop(spark, sf_dir)
    counts = stats.search_keywords(s.searches(), tz="Asia/Shanghai")
    return s.drain(counts, "search_keywords")


def product_keyword_sum_stream(spark, sf_dir):
    """Reads the product statistics as the topic before it wrote them."""
    s = StreamShop(spark, sf_dir)
    rows = [m.clicks(s.pages(delay=None)), m.carts(s.carts()), m.orders(s.wide_topic())]
    totals = s.topic(
        enrich(stats.product_stats(rows, DAY), s.sku_dim()), "product_stats",
        dict(edt=FAR_TEXT, sku_name="", click_ct=1, cart_ct=0, order_ct=0),
    )
    return s.drain(stats.product_keywords(totals), "product_keywords")


def display_explode_stream(spark, sf_dir):
    """Log text to flattened displays; nothing here keeps state."""
    s = StreamShop(spark, sf_dir, closing=False)
    log, _ = parse_json(s.raw_logs(), schemas.LOG)
    shown = flatten_displays(log, ["tie"]).select(
        F.col("tie").alias("event_id"), "mid", "vc", "ch", "ar", "page_id",
        "item", "item_type", "during_time", "ts",
    )
    return s.drain(shown, "displays")


def log_landing_stream(spark, sf_dir):
    """Raw log text into one folder per day of arrival, and read back."""
    s = StreamShop(spark, sf_dir, closing=False)
    base = scratch_dir(s.spark, "landing")
    raw = s.raw_logs()
    start(
        s.spark, landing_sink(raw, f"{base}/out"), f"{base}/checkpoint", drain=True
    ).awaitTermination()
    landed, _ = parse_json(s.spark.read.parquet(f"{base}/out").select("value"), schemas.LOG)
    return landed.select(F.col("common.mid").alias("mid"), "ts", "page.page_id")


def _routed(s: StreamShop) -> tuple[str, str]:
    """Change records through the routing sink; (facts, dimensions) folders."""
    base = scratch_dir(s.spark, "routing")
    changes, _ = parse_json(s.raw_changes(), schemas.CHANGE)
    facts, dims = f"{base}/facts", f"{base}/dims"
    writer = routing_sink(changes, lambda _: s.routes(), DATABASE, facts, dims)
    start(s.spark, writer, f"{base}/checkpoint", drain=True).awaitTermination()
    return facts, dims


def routed_facts_stream(spark, sf_dir):
    s = StreamShop(spark, sf_dir, closing=False)
    facts, _ = _routed(s)
    data = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return s.spark.read.parquet(facts).select(
        "sink_table", data_text(data).alias("data")
    )


def routed_dims_stream(spark, sf_dir):
    """Two dimensions from one routed stream, read back as tables."""
    s = StreamShop(spark, sf_dir, closing=False)
    _, dims = _routed(s)
    users = read_dim(s.spark, f"{dims}/dim_user_info").select(
        F.lit("dim_user_info").alias("sink_table"), "ID", "NAME"
    )
    skus = read_dim(s.spark, f"{dims}/dim_sku_info").select(
        F.lit("dim_sku_info").alias("sink_table"), "ID", F.col("SKU_NAME").alias("NAME")
    )
    return users.unionByName(skus).select(
        "sink_table", F.col("ID").alias("id"), F.col("NAME").alias("name")
    )


def _user_dim(s: StreamShop) -> str:
    """All versions of the customers, upserted by two queries with a base in between.

    Updates carry fewer columns than inserts. The second query has a checkpoint
    of its own, so it numbers its batches from 0 as the first did.
    """
    base = scratch_dir(s.spark, "upserts")
    routes = s.spark.createDataFrame(
        [("user_info", "insert", "hbase", "dim_user", "id,name,nation", None, None),
         ("user_info", "update", "hbase", "dim_user", "id,name", None, None)], schemas.ROUTES)
    for wave in (1, 2):
        changes, _ = parse_json(s.user_changes(wave), schemas.CHANGE)
        writer = routing_sink(
            changes, lambda _: routes, DATABASE, f"{base}/facts", f"{base}/dims")
        start(s.spark, writer, f"{base}/checkpoint-{wave}", drain=True).awaitTermination()
        if wave == 1:
            compact_dim(s.spark, f"{base}/dims/dim_user")
    return f"{base}/dims/dim_user"


def upserted_dims_stream(spark, sf_dir):
    """Several versions of each key, some of the same second, some late."""
    s = StreamShop(spark, sf_dir, closing=False)
    return read_dim(s.spark, _user_dim(s)).select(
        F.col("ID").alias("id"), F.col("NAME").alias("name"), F.col("NATION").alias("nation"))


def refreshed_lookup_stream(spark, sf_dir):
    """Orders named from a dimension that is read anew, for the batch's keys only."""
    s = StreamShop(spark, sf_dir, closing=False)
    dim, out = _user_dim(s), scratch_dir(s.spark, "refreshed")
    orders = s.order_info().select(F.col("id").alias("order_id"), "user_id")

    def lookups(batch: DataFrame) -> list[Dim]:
        asked = batch.select(F.col("user_id").alias("ID"))
        users = read_dim(batch.sparkSession, dim, wanted=asked)
        return [Dim("user", users, "user_id", {"user_name": "NAME", "user_nation": "NATION"})]

    writer = enriching_sink(orders, lookups, f"{out}/rows")
    start(s.spark, writer, f"{out}/checkpoint", drain=True).awaitTermination()
    return s.spark.read.parquet(f"{out}/rows").select(
        "order_id", "user_id", "user_name", "user_nation")


def log_split_stream(spark, sf_dir):
    """Start, page and display records from one query with one new-visitor state."""
    s = StreamShop(spark, sf_dir)
    raw = s.raw_logs()
    repaired, _ = layers.repaired_log(raw, "1 hour")
    out = scratch_dir(s.spark, "log_parts")
    start_split(
        s.spark, repaired, layers.log_parts, f"{out}/parts", f"{out}/checkpoint", drain=True,
        state_partitions=s.spark.sparkContext.defaultParallelism, count_state=False,
    ).awaitTermination()
    start_, page, display = (
        s.spark.read.parquet(f"{out}/parts/{n}") for n in ("start", "page", "display"))
    none = F.lit(None).cast("string")
    return m.union_all([
        start_.select(
            F.lit("start").alias("output"), F.col("common.mid").alias("mid"), "ts",
            F.col("start.entry").alias("name"), none.alias("item")),
        page.select(
            F.lit("page").alias("output"), F.col("common.mid").alias("mid"), "ts",
            F.col("page.page_id").alias("name"), F.col("page.item").alias("item")),
        display.select(
            F.lit("display").alias("output"), "mid", "ts", F.col("page_id").alias("name"), "item"),
    ]).filter(F.col("ts") < FAR_MILLIS)


def serving_stream(spark, sf_dir):
    """Province statistics through the serving sink, a field left out, and read back."""
    s = StreamShop(spark, sf_dir)
    named = enrich(s.wide_topic(), [d for d in s.order_dims() if d.name == "province"])
    table = stats.province_stats(named, DAY).withColumn(
        "left_out", hidden(F.lit("x"), "left_out"))
    base = scratch_dir(s.spark, "serving")
    start(
        s.spark, serving_sink(table, f"{base}/rows"), f"{base}/checkpoint", drain=True,
        state_partitions=s.spark.sparkContext.defaultParallelism, count_state=False,
    ).awaitTermination()
    return plain(read_serving(s.spark, f"{base}/rows").drop("dt"))


STREAMING = {
    f.__name__: f
    for f in (
        new_visitor_flag_stream, daily_unique_visitor_stream, user_jump_stream,
        user_jump_timeout_only_stream, order_wide_interval_stream,
        payment_wide_interval_stream, dim_enrich_stream, visitor_stats_stream,
        product_stats_stream, province_stats_stream, search_keyword_count_stream,
        product_keyword_sum_stream, display_explode_stream, log_landing_stream,
        routed_facts_stream, routed_dims_stream, upserted_dims_stream, refreshed_lookup_stream,
        log_split_stream, serving_stream,
    )
}
