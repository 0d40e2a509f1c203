"""The registered queries: each reads a folder of tables and returns a frame."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwater import schemas
from tillwater import functions as fn
from tillwater.functions import now_millis
from tillwater.functions.sql import register
from tillwater.operators import changes as ch, dashboard as dash, measures as m, stats
from tillwater.operators.firsts import daily_unique, flag_new_visitors, latest_per_key
from tillwater.operators.joins import MISSING, enrich
from tillwater.operators.jumps import TIMEOUT_ONLY, user_jump
from tillwater.operators.logs import flatten_displays, log_outputs, split_log
from tillwater.operators.parsing import others, parse_dynamic, parse_json, to_json_text
from tillwater.operators.wide import order_wide, payment_wide
from tillwater.plans.shop import ASOF, DATABASE, JUMP_WITHIN, LINE_LOWER, LINE_UPPER, Shop
from tillwater.session import staged, tune
from tillwater.sources.streams import literal_records

HOUR, DAY, MONTH = "1 hour", "1 day", "30 days"
GMV_DATE = dt.date(1998, 6, 1)


def plain(df: DataFrame) -> DataFrame:
    """Amounts as doubles, for comparing with other engines."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def shop(spark: SparkSession, sf_dir: str) -> Shop:
    return Shop(tune(spark), sf_dir)


# --- pieces shared by several queries ----------------------------------------

def line_stats(s: Shop) -> DataFrame:
    """Order lines as rows of the product serving table."""
    return s.order_detail().select(
        F.col("create_time").alias("stt"), "sku_id",
        F.col("split_total_amount").alias("order_amount"),
    )


def page_fields(pages: DataFrame) -> list:
    return [F.col("tie").alias("event_id"), F.col("mid"), F.col("ts")]


def wide(s: Shop) -> DataFrame:
    return order_wide(s.order_info(), s.order_detail(), LINE_LOWER, LINE_UPPER)


def paid(s: Shop, orders: DataFrame | None = None) -> DataFrame:
    return payment_wide(s.payment_info(), wide(s) if orders is None else orders)


def visits(s: Shop, tz: str | None = None) -> DataFrame:
    pages = s.pages()
    uv = daily_unique(pages, "mid", "et", "tie")
    uj = user_jump(pages, "mid", "et", m.is_entry(), "tie", JUMP_WITHIN)
    return stats.visitor_stats(pages, uv, uj, HOUR, tz=tz)


def product_totals(s: Shop, named: bool = True) -> DataFrame:
    # Orders and payments both start from the wide orders, so those are a stage.
    orders = staged(wide(s).select(
        "order_id", "sku_id", "sku_num", "split_total_amount", "create_time", "ts"), "order_wide")
    rows = [
        s.event_measures(), m.orders(orders), m.payments(paid(s, orders)), m.refunds(s.refunds())]
    totals = stats.product_stats(rows, DAY)
    return enrich(totals, s.product_dims()) if named else totals


def provinces(s: Shop) -> DataFrame:
    named = enrich(wide(s), [d for d in s.order_dims() if d.name == "province"])
    return stats.province_stats(named, DAY)


def interactions(s: Shop) -> DataFrame:
    """Clicks, carts and order lines per sku and day, without order counting."""
    return stats.product_stats(
        [m.clicks(s.pages()), m.carts(s.carts()), m.orders(wide(s))], DAY
    )


def product_words(s: Shop) -> DataFrame:
    return stats.product_keywords(enrich(interactions(s), s.sku_dim()))


# --- dashboard ------------------------------------------------------------------

def gmv_day(spark, sf_dir):
    return plain(dash.gmv_day(line_stats(shop(spark, sf_dir))))


def gmv_on_date(spark, sf_dir):
    """The stored time column meets the day's bounds, so the scan can use them."""
    lines = shop(spark, sf_dir).read("lineitem").select(
        F.col("l_shipdate").alias("stt"),
        F.col("l_extendedprice").cast("decimal(20,2)").alias("order_amount"),
    )
    return plain(dash.gmv_day(lines, GMV_DATE))


def gmv_by_brand(spark, sf_dir):
    s = shop(spark, sf_dir)
    days = dash.product_days(line_stats(s), s.product_dims("trademark"))
    return plain(dash.gmv_by(days, ["tm_id", "tm_name"]))


def gmv_by_category(spark, sf_dir):
    s = shop(spark, sf_dir)
    days = dash.product_days(line_stats(s), s.product_dims("category3"))
    return plain(dash.gmv_by(days, ["category3_id", "category3_name"]))


def gmv_by_product(spark, sf_dir):
    s = shop(spark, sf_dir)
    totals = stats.product_stats([m.orders(s.order_detail())], DAY)
    days = dash.product_days(totals, s.product_dims("spu"), orders=True)
    return plain(dash.gmv_by(days, ["spu_id", "spu_name"], orders=True))


def province_amount(spark, sf_dir):
    return plain(dash.province_amount(provinces(shop(spark, sf_dir))))


def visitor_by_hour_dense(spark, sf_dir):
    return dash.visitors_by_hour(visits(shop(spark, sf_dir)))


def keyword_score(spark, sf_dir):
    s = shop(spark, sf_dir)
    words = stats.search_keywords(s.searches(), HOUR).unionByName(product_words(s))
    return dash.keyword_score(words)


# --- first records and jumps -------------------------------------------------------

def new_visitor_flag(spark, sf_dir):
    flagged = flag_new_visitors(shop(spark, sf_dir).pages(), "mid", "et", "tie")
    return flagged.select(*page_fields(flagged), "is_new")


def daily_unique_visitor(spark, sf_dir):
    uv = daily_unique(shop(spark, sf_dir).pages(), "mid", "et", "tie")
    return uv.select(*page_fields(uv))


def _jumps(spark, sf_dir, **options):
    s = shop(spark, sf_dir)
    uj = user_jump(s.pages(), "mid", "et", m.is_entry(), "tie", JUMP_WITHIN, **options)
    return uj.select(*page_fields(uj))


def user_jump_pages(spark, sf_dir):
    return _jumps(spark, sf_dir)


def user_jump_timeout_only(spark, sf_dir):
    return _jumps(spark, sf_dir, mode=TIMEOUT_ONLY)


def latest_event(spark, sf_dir):
    events = shop(spark, sf_dir).batch("events")
    newest = latest_per_key(events, ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value")


# --- wide tables ------------------------------------------------------------------

def order_wide_interval(spark, sf_dir):
    return plain(wide(shop(spark, sf_dir)))


def payment_wide_interval(spark, sf_dir):
    return plain(paid(shop(spark, sf_dir)))


def dim_enrich(spark, sf_dir):
    s = shop(spark, sf_dir)
    return plain(enrich(wide(s), s.order_dims()).select(
        "detail_id", "order_id", "sku_id", "create_time", "split_total_amount",
        "user_gender", "user_age", "province_name", "province_3166_2_code",
        "province_area_code", "province_iso_code", "sku_name", "sku_price",
        "spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name",
    ))


def dim_enrich_missing(spark, sf_dir):
    """Events whose sku or user the dimension does not have."""
    s = shop(spark, sf_dir)
    users = [d for d in s.order_dims() if d.name == "user"]
    seen = s.read("events").select(
        "event_id", "user_id", (F.col("event_id") * 3).alias("sku_id")
    )
    marked = enrich(seen, [*users, *s.sku_dim()], mark_missing=True)
    return marked.select(
        "event_id", "user_id", "sku_id", "user_gender", "sku_name",
        F.array_join(MISSING, ",").alias("missing"),
    )


def user_age(spark, sf_dir):
    s = shop(spark, sf_dir)
    return s.users().select(
        F.col("ID").alias("user_id"), "BIRTHDAY",
        fn.age_years("BIRTHDAY", F.lit(ASOF).cast("timestamp")).alias("age"),
    )


# --- statistics -------------------------------------------------------------------

def visitor_stats(spark, sf_dir):
    return visits(shop(spark, sf_dir))


def product_stats(spark, sf_dir):
    return plain(product_totals(shop(spark, sf_dir)))


def province_stats(spark, sf_dir):
    return plain(provinces(shop(spark, sf_dir)))


def search_keyword_count(spark, sf_dir):
    """Windows are cut in UTC and shown in Shanghai time."""
    return stats.search_keywords(shop(spark, sf_dir).searches(), tz="Asia/Shanghai")


def page_search_count(spark, sf_dir):
    """Searches found in the page log itself."""
    return stats.search_keywords(m.searches(shop(spark, sf_dir).pages()), HOUR)


def product_keyword_sum(spark, sf_dir):
    return product_words(shop(spark, sf_dir))


# --- logs ----------------------------------------------------------------------------

def _split(s: Shop):
    return split_log(parse_json(s.raw_logs(), schemas.LOG)[0])


def log_split(spark, sf_dir):
    """Every record of the three outputs, from JSON text that is parsed once."""
    s = shop(spark, sf_dir)
    log, _ = parse_json(s.raw_logs(), schemas.LOG)
    return log_outputs(log)


def log_split_parts(spark, sf_dir):
    """The three outputs as frames of their own, as the layers pass them on."""
    start, page, display = _split(shop(spark, sf_dir))
    none = F.lit(None).cast("string")
    return m.union_all([
        start.select(
            F.lit("start").alias("output"), F.col("common.mid").alias("mid"), "ts",
            F.col("start.entry").alias("name"), none.alias("item"),
        ),
        page.select(
            F.lit("page").alias("output"), F.col("common.mid").alias("mid"), "ts",
            F.col("page.page_id").alias("name"), F.col("page.item").alias("item"),
        ),
        display.select(
            F.lit("display").alias("output"), "mid", "ts",
            F.col("page_id").alias("name"), "item",
        ),
    ])


def display_explode(spark, sf_dir):
    log, _ = parse_json(shop(spark, sf_dir).raw_logs(), schemas.LOG)
    shown = flatten_displays(log, ["tie"])
    return shown.select(
        F.col("tie").alias("event_id"), "mid", "vc", "ch", "ar", "page_id",
        "item", "item_type", "during_time", "ts",
    )


def json_records(spark, sf_dir):
    """Page records out to JSON text and in again; the text is compared too."""
    pages = shop(spark, sf_dir).pages().select(
        F.col("tie").alias("event_id"), F.col("mid"), F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"), "ts",
    )
    text = to_json_text(pages, keep=["event_id"])
    kept = text.withColumn("text", F.col("value"))
    back, _ = parse_json(kept, pages.drop("event_id").schema)
    return back


def log_rejects(spark, sf_dir):
    """Documents among log records: what parses and what does not, told apart."""
    s = shop(spark, sf_dir)
    documents = s.batch("documents").select(
        F.col("doc_id").alias("tie"), F.col("text").alias("value"))
    good, rejects = parse_json(s.raw_logs().unionByName(documents), schemas.LOG)
    return good.select(
        F.lit("record").alias("output"), "tie", F.col("ts").alias("number")
    ).unionByName(rejects.select(
        F.lit("reject").alias("output"), "tie", F.length("value").cast("long").alias("number")))


def product_rejects(spark, sf_dir):
    """Clicks and carts, some with unreadable products or times: counted and rejected."""
    s = shop(spark, sf_dir)
    pages = s.pages().withColumn("page", F.col("page").withField(
        "item", F.when(F.col("tie") % 7 == 0, F.concat(F.lit("no "), F.col("page.item")))
        .otherwise(F.col("page.item"))))
    carts = s.carts().select("sku_id", F.when(
        F.col("sku_id") % 5 == 0, F.lit("soon")).otherwise(F.col("create_time"))
        .alias("create_time"))
    good, bad = zip(*[m.split_usable(rows) for rows in (m.clicks(pages), m.carts(carts))],
                    strict=True)
    totals = stats.product_stats(list(good), DAY).agg(
        F.sum("click_ct").alias("click_ct"), F.sum("cart_ct").alias("cart_ct"))
    lost = m.union_all(list(bad)).agg(
        F.sum("click_ct").alias("click_ct"), F.sum("cart_ct").alias("cart_ct"))
    return totals.select(F.lit("counted").alias("output"), "*").unionByName(
        lost.select(F.lit("rejected").alias("output"), "*"))


# --- change records ---------------------------------------------------------------

def _changes(s: Shop) -> DataFrame:
    return parse_json(s.raw_changes(), schemas.CHANGE)[0]


def data_text(c="data"):
    """A map as text in key order."""
    entries = F.array_sort(F.map_entries(c))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"
    )


def cdc_filter(spark, sf_dir):
    kept = ch.clean_changes(_changes(shop(spark, sf_dir)), DATABASE)
    return kept.select(
        F.col("table").alias("source_table"), "type", F.col("data")["id"].alias("id"),
        data_text().alias("data"),
    )


def column_prune(spark, sf_dir):
    s = shop(spark, sf_dir)
    kept = ch.clean_changes(_changes(s), DATABASE)
    return ch.prune_columns(ch.match_routes(kept, s.routes())).select(
        "sink_table", F.col("data")["id"].alias("id"), data_text().alias("data")
    )


def config_route(spark, sf_dir):
    s = shop(spark, sf_dir)
    routed = ch.route(ch.clean_changes(_changes(s), DATABASE), s.routes())
    return routed.select(
        "sink_type", "sink_table", "sink_pk", F.col("data")["id"].alias("id"),
        data_text().alias("data"),
    )


# --- functions -----------------------------------------------------------------------

def time_functions(spark, sf_dir):
    pages = shop(spark, sf_dir).pages()
    text = fn.millis_to_text("ts")
    return pages.select(
        F.col("tie").alias("event_id"), text.alias("time_text"),
        fn.text_to_millis(text).alias("millis"),
        fn.day_of("et").cast("string").alias("day"),
        fn.date_part(text).alias("date_part"), fn.hour_part(text).alias("hour_part"),
        fn.day_key("et").alias("day_key"), fn.hour_of("et").alias("hour"),
        fn.local_text("et", "Asia/Shanghai").alias("shanghai_text"),
        fn.day_of("et", "Asia/Shanghai").cast("string").alias("shanghai_day"),
    )


def text_functions(spark, sf_dir):
    """Null, empty, blank and full text; keys that are there and keys that are not."""
    events = shop(spark, sf_dir).batch("events")
    kind, n = F.col("event_type"), F.col("event_id")
    text = F.when(n % 4 == 1, "").when(n % 4 == 2, " ").when(n % 4 == 3, kind)
    data = F.create_map(F.lit("k"), n.cast("string"), F.concat(F.lit("kind"), n % 2), kind)
    wanted = F.concat(F.lit("kind0,x,"), F.when(n % 3 == 0, "k").otherwise("K"))
    source = F.element_at(F.array(*[F.lit(w) for w in ("search", "click", "cart", "order", "x")]),
                          (n % 5 + 1).cast("int"))
    return events.select(
        "event_id",
        fn.is_blank(text).alias("blank"),
        fn.source_weight(source).cast("int").alias("weight"),
        fn.upper_keys(data)["KIND1"].alias("kind"),
        F.size(fn.keep_keys(data, wanted)).alias("kept"),
        fn.drop_bootstrap(F.concat(
            F.when(n % 2 == 0, "bootstrap-").otherwise("x-bootstrap-"), kind)).alias("plain"),
    )


def document_words(spark, sf_dir):
    """Distinct words of each whole document."""
    documents = shop(spark, sf_dir).batch("documents")
    return documents.select("doc_id", F.explode(fn.tokenize("text")).alias("word"))


def source_unpivot(spark, sf_dir):
    totals = interactions(shop(spark, sf_dir))
    live = totals.filter(fn.any_positive("click_ct", "cart_ct", "order_ct"))
    return live.select(
        "stt", "sku_id", F.inline(fn.positive_sources("click_ct", "cart_ct", "order_ct"))
    )


def lateral_keywords(spark, sf_dir):
    """Product names cut and unpivoted in SQL, with two lateral views."""
    s = shop(spark, sf_dir)
    register(s.spark)
    named = enrich(interactions(s), s.sku_dim())
    return s.spark.sql(
        """
        SELECT stt, edt, keyword, source, sum(ct) AS ct
        FROM (
          SELECT stt, edt, split_words(sku_name) AS words,
                 positive_sources(click_ct, cart_ct, order_ct) AS pairs
          FROM {named} WHERE click_ct > 0 OR cart_ct > 0 OR order_ct > 0
        )
        LATERAL VIEW explode(words) w AS keyword
        LATERAL VIEW inline(pairs) p AS source, ct
        GROUP BY stt, edt, keyword, source
        """,
        named=named,
    )


def lateral_table_functions(spark, sf_dir):
    """The same through table functions, in comma form and in join form."""
    s = shop(spark, sf_dir)
    register(s.spark)
    named = enrich(interactions(s), s.sku_dim()).select(
        "stt", "edt", "sku_name", "click_ct", "cart_ct", "order_ct")
    forms = {
        "comma": "{named}, LATERAL words_of(sku_name) AS w(keyword), "
                 "LATERAL product_sources(click_ct, cart_ct, order_ct) AS p(source, ct)",
        "join": "{named} JOIN LATERAL words_of(sku_name) AS w(keyword) ON true "
                "JOIN LATERAL product_sources(click_ct, cart_ct, order_ct) AS p(source, ct) ON true",
    }
    return m.union_all([
        s.spark.sql(
            f"SELECT '{name}' AS form, stt, edt, keyword, source, sum(ct) AS ct FROM {tables} "
            "GROUP BY stt, edt, keyword, source", named=named)
        for name, tables in forms.items()])


def _brand_lines(s: Shop) -> DataFrame:
    """Order lines with their brand and event time."""
    named = enrich(s.order_detail(), s.product_dims("trademark"))
    return named.select("order_id", "tm_id", "et")


def orders_by_brand_exact(spark, sf_dir):
    """Each brand's orders over all windows, once each, beside the sum of its windows."""
    bits = staged(
        stats.order_bits(_brand_lines(shop(spark, sf_dir)), ["tm_id"], MONTH), "order_bits")
    windows = stats.distinct_orders(bits, ["stt", "tm_id"]).groupBy("tm_id").agg(
        F.sum("order_ct").alias("sum_of_windows"))
    return stats.distinct_orders(bits, ["tm_id"]).join(windows, "tm_id")


def dynamic_records(spark, sf_dir):
    """Log records with fields outside the schema, and documents among them."""
    s = shop(spark, sf_dir)
    logs = s.event_records().selectExpr(
        "tie", "to_json(struct(common, page, ts, event_type AS kind, "
        "named_struct('k', k, 'tags', array(event_type, 'x')) AS extra)) AS value")
    documents = s.batch("documents").select(
        F.col("doc_id").alias("tie"), F.col("text").alias("value"))
    good, rejects = parse_dynamic(logs.unionByName(documents), schemas.LOG)
    rest = others("record", schemas.LOG)
    none = F.lit(None).cast("string")
    return good.select(
        F.lit("record").alias("output"), "tie", F.col("common.mid").alias("mid"), "ts",
        F.variant_get("record", "$.extra.tags[0]", "string").alias("tag"),
        F.array_join(F.array_sort(F.map_keys(rest)), ",").alias("unknown"),
        F.to_json(rest["extra"]).alias("extra"),
    ).unionByName(rejects.select(
        F.lit("reject").alias("output"), "tie", none.alias("mid"),
        F.length("value").cast("long").alias("ts"), none.alias("tag"), none.alias("unknown"),
        none.alias("extra")))


def stamped_now(spark, sf_dir):
    """Events stamped with the time of processing, held against the clock around it."""
    events = shop(spark, sf_dir).batch("events")
    before = int(time.time() * 1000) - 1
    stamp = events.select("event_id", now_millis().alias("stamp"))
    # The query may run up to a day after it is made.
    return stamp.select("event_id", F.col("stamp").between(
        before, before + 86_400_000).alias("is_now"))


def literal_weights(spark, sf_dir):
    """Records given in place, parsed like a topic and joined with the events' kinds."""
    s = shop(spark, sf_dir)
    given = literal_records(s.spark, [
        {"kind": "view", "weight": 2}, {"kind": "click", "weight": 4},
        {"kind": "purchase", "weight": 8}, {"kind": "other"}])
    weights, _ = parse_json(given, schemas.shape(kind="string", weight="bigint"))
    return s.batch("events").join(weights, F.col("event_type") == F.col("kind")).groupBy(
        "kind").agg(F.sum("weight").alias("score"))


BATCH = {
    "gmv_day": gmv_day,
    "gmv_on_date": gmv_on_date,
    "gmv_by_brand": gmv_by_brand,
    "gmv_by_category": gmv_by_category,
    "gmv_by_product": gmv_by_product,
    "province_amount": province_amount,
    "visitor_by_hour_dense": visitor_by_hour_dense,
    "keyword_score": keyword_score,
    "new_visitor_flag": new_visitor_flag,
    "daily_unique_visitor": daily_unique_visitor,
    "user_jump": user_jump_pages,
    "user_jump_timeout_only": user_jump_timeout_only,
    "latest_per_key": latest_event,
    "order_wide_interval": order_wide_interval,
    "payment_wide_interval": payment_wide_interval,
    "dim_enrich": dim_enrich,
    "dim_enrich_missing": dim_enrich_missing,
    "user_age": user_age,
    "visitor_stats": visitor_stats,
    "product_stats": product_stats,
    "province_stats": province_stats,
    "search_keyword_count": search_keyword_count,
    "page_search_count": page_search_count,
    "product_keyword_sum": product_keyword_sum,
    "log_split": log_split,
    "log_split_parts": log_split_parts,
    "display_explode": display_explode,
    "json_records": json_records,
    "log_rejects": log_rejects,
    "product_rejects": product_rejects,
    "cdc_filter": cdc_filter,
    "column_prune": column_prune,
    "config_route": config_route,
    "time_functions": time_functions,
    "text_functions": text_functions,
    "document_words": document_words,
    "source_unpivot": source_unpivot,
    "lateral_keywords": lateral_keywords,
    "lateral_table_functions": lateral_table_functions,
    "orders_by_brand_exact": orders_by_brand_exact,
    "dynamic_records": dynamic_records,
    "stamped_now": stamped_now,
    "literal_weights": literal_weights,
}
