"""The same answers in ANSI SQL, for checking against another engine."""

from __future__ import annotations

PAGE_CTES = """
ev AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts, make_timestamp(epoch_us(ts) // 1000 * 1000) AS et,
         CAST(user_id AS VARCHAR) AS mid, event_type, value,
         CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k,
         CAST(user_id % 25 AS VARCHAR) AS ar
  FROM events
),
logs AS (
  SELECT *, 'v' || (k % 4) AS vc, 'ch' || (k % 3) AS ch,
         CASE event_type WHEN 'signup' THEN '1' ELSE '0' END AS is_new,
         CASE event_type WHEN 'signup' THEN 'home' WHEN 'view' THEN 'good_list'
                         WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'payment' END AS page_id,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_list'
                         WHEN 'purchase' THEN 'good_detail' END AS last_page_id,
         CASE event_type WHEN 'view' THEN 'Word ' || k WHEN 'click' THEN '' || k
                         WHEN 'purchase' THEN '' || k END AS item,
         CASE event_type WHEN 'view' THEN 'keyword' WHEN 'click' THEN 'sku_id'
                         WHEN 'purchase' THEN 'sku_id' END AS item_type,
         CAST(round(value * 1000) AS BIGINT) AS during_time
  FROM ev
),
pages AS (SELECT * FROM logs WHERE event_type <> 'error'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, event_id) AS rn,
         row_number() OVER (PARTITION BY mid, CAST(et AS DATE) ORDER BY ts, event_id) AS rn_day,
         lead(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) AS next_ts,
         lead(event_type) OVER (PARTITION BY mid ORDER BY ts, event_id) AS next_type
  FROM pages
),
shown AS (
  SELECT event_id, mid, vc, ch, ar, page_id, ts, et, during_time,
         coalesce(item, CAST((k + i) % 100 AS VARCHAR)) AS item,
         coalesce(item_type, CASE WHEN i < 2 THEN 'sku_id' ELSE 'activity_id' END) AS item_type
  FROM logs, range(3) r(i)
  WHERE event_type IN ('signup', 'view') AND i <= k % 3
)
"""

SIX_HOURS = 6 * 3600 * 1000

WIDE_CTES = """
owide AS (
  SELECT l_orderkey * 10 + l_linenumber AS detail_id, o_orderkey AS order_id,
         l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num,
         round(CAST(l_extendedprice AS DECIMAL(20,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS split_coupon_amount,
         CAST(l_extendedprice AS DECIMAL(20,2)) AS split_total_amount,
         o_custkey % 25 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
         CAST(o_totalprice AS DECIMAL(20,2)) AS total_amount, o_orderdate, o_orderpriority,
         o_orderdate + to_minutes(o_orderkey % 90) AS pay_time
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 100 DAY AND o_orderdate + INTERVAL 100 DAY
),
pwide AS (
  SELECT * FROM owide
  WHERE o_orderdate BETWEEN pay_time - INTERVAL 45 MINUTE AND pay_time + INTERVAL 5 SECOND
)
"""

DIM_CTES = """
sku AS (
  SELECT p_partkey AS sku_id, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(20,2)) AS sku_price,
         CAST(p_size AS BIGINT) AS spu_id, 'size ' || p_size AS spu_name,
         CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS tm_id, p_brand AS tm_name,
         CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS category3_id, p_type AS category3_name
  FROM part
),
province AS (
  SELECT n_nationkey AS province_id, n_name AS province_name, 'N-' || n_nationkey AS province_3166_2_code,
         'R' || n_regionkey AS province_area_code, 'I' || n_nationkey AS province_iso_code
  FROM nation
),
customers AS (
  SELECT c_custkey AS user_id, c_mktsegment AS user_gender,
         DATE '1960-01-01' + CAST(c_custkey * 37 % 15000 AS INTEGER) AS birthday
  FROM customer
)
"""

AGE = "CAST(date_diff('day', birthday, DATE '2024-01-01') // 365 AS INTEGER)"


def _text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def _hour_bounds(expr: str) -> str:
    start = f"date_trunc('hour', {expr})"
    return f"{_text(start)} AS stt, {_text(start + ' + INTERVAL 1 HOUR')} AS edt"


def _day_bounds(expr: str) -> str:
    start = f"date_trunc('day', {expr})"
    return f"{_text(start)} AS stt, {_text(start + ' + INTERVAL 1 DAY')} AS edt"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_JUMP = f"event_type = 'signup' AND (next_ts IS NULL OR next_ts - ts >= {SIX_HOURS}"

VISITOR_CTES = f"""
visits AS (
  SELECT et, vc, ch, ar, is_new, 0 AS uv, 1 AS pv,
         CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS sv, 0 AS uj, during_time AS dur FROM pages
  UNION ALL SELECT et, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM ranked WHERE rn_day = 1
  UNION ALL SELECT et, vc, ch, ar, is_new, 0, 0, 0, 1, 0 FROM ranked
            WHERE {_JUMP} OR next_type = 'signup')
)
"""

# One row per recorded fact; later sums are over these.
FACT_CTES = """
facts AS (
  SELECT CAST(et AS DATE) AS d, CAST(item AS BIGINT) AS sku_id, 'click' AS kind, NULL AS order_id,
         0 AS num, CAST(0 AS DECIMAL(20,2)) AS amount FROM pages WHERE item_type = 'sku_id'
  UNION ALL SELECT CAST(et AS DATE), CAST(item AS BIGINT), 'display', NULL, 0, 0 FROM shown WHERE item_type = 'sku_id'
  UNION ALL SELECT CAST(et AS DATE), k, 'favor', NULL, 0, 0 FROM ev WHERE event_type = 'view'
  UNION ALL SELECT CAST(et AS DATE), k, 'cart', NULL, 0, 0 FROM ev WHERE event_type = 'purchase'
  UNION ALL SELECT CAST(o_orderdate AS DATE), sku_id, 'order', order_id, sku_num, split_total_amount FROM owide
  UNION ALL SELECT CAST(pay_time AS DATE), sku_id, 'paid', order_id, 0, split_total_amount FROM pwide
  UNION ALL SELECT CAST(l_shipdate AS DATE), l_partkey, 'refund', l_orderkey, 0, CAST(l_extendedprice AS DECIMAL(20,2))
            FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT CAST(et AS DATE), k, CASE WHEN k % 6 IN (4, 5) THEN 'good' ELSE 'comment' END, NULL, 0, 0
            FROM ev WHERE event_type = 'error'
)
"""


def _n(kind: str) -> str:
    return f"count(*) FILTER (kind = '{kind}')"


def _amount(kind: str) -> str:
    return f"CAST(coalesce(sum(amount) FILTER (kind = '{kind}'), 0) AS DOUBLE)"


def _ids(kind: str) -> str:
    return f"count(DISTINCT order_id) FILTER (kind = '{kind}')"


TOTAL_CTES = f"""
totals AS (
  SELECT strftime(d, '%Y-%m-%d 00:00:00') AS stt,
         strftime(d + INTERVAL 1 DAY, '%Y-%m-%d 00:00:00') AS edt, sku_id,
         {_n('click')} AS click_ct, {_n('display')} AS display_ct, {_n('favor')} AS favor_ct,
         {_n('cart')} AS cart_ct, CAST(sum(num) AS BIGINT) AS order_sku_num,
         count(*) FILTER (kind IN ('comment', 'good')) AS comment_ct, {_n('good')} AS good_comment_ct,
         {_amount('order')} AS order_amount, {_amount('paid')} AS payment_amount,
         {_amount('refund')} AS refund_amount,
         {_ids('order')} AS order_ct, {_ids('paid')} AS paid_order_ct, {_ids('refund')} AS refund_order_ct
  FROM facts GROUP BY d, sku_id
)
"""

_WORDS = "unnest(list_distinct(list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')))"

SOURCE_CTES = """
sources AS (
  SELECT stt, edt, sku_id, 'click' AS source, click_ct AS ct FROM totals WHERE click_ct > 0
  UNION ALL SELECT stt, edt, sku_id, 'cart', cart_ct FROM totals WHERE cart_ct > 0
  UNION ALL SELECT stt, edt, sku_id, 'order', order_ct FROM totals WHERE order_ct > 0
)
"""

PRODUCT_WORD_CTES = f"""
named AS (SELECT stt, edt, source, ct, {_WORDS.format('sku_name')} AS keyword FROM sources JOIN sku USING (sku_id)),
product_words AS (
  SELECT stt, edt, keyword, source, CAST(sum(ct) AS BIGINT) AS ct FROM named GROUP BY ALL
)
"""

_SEARCH = f"""
searched AS (
  SELECT TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS et, {_WORDS.format('text')} AS keyword FROM documents
)
"""

_INTERACTIONS = _with(PAGE_CTES, WIDE_CTES, FACT_CTES, TOTAL_CTES, DIM_CTES, SOURCE_CTES)

PROVINCE_CTES = f"""
province_totals AS (
  SELECT province_id, province_name, province_area_code AS area_code, province_iso_code AS iso_code,
         province_3166_2_code AS iso_3166_2, {_day_bounds('o_orderdate')},
         sum(split_total_amount) AS amount, count(DISTINCT order_id) AS order_count
  FROM owide LEFT JOIN province USING (province_id) GROUP BY ALL
)
"""

CHANGE_CTES = """
records AS (
  SELECT 'user_info' AS t, c_custkey AS key, 'id=' || c_custkey || ';name=' || c_name || ';nation=' || c_nationkey
         || ';segment=' || c_mktsegment AS data,
         'id=' || c_custkey || ';name=' || c_name || ';nation=' || c_nationkey AS pruned FROM customer
  UNION ALL
  SELECT 'sku_info', p_partkey, 'id=' || p_partkey || ';size=' || p_size || ';sku_name=' || p_name,
         'id=' || p_partkey || ';sku_name=' || p_name FROM part
  UNION ALL
  SELECT 'order_info', o_orderkey, 'id=' || o_orderkey || ';priority=' || o_orderpriority || ';status='
         || o_orderstatus || ';user_id=' || o_custkey,
         'id=' || o_orderkey || ';status=' || o_orderstatus || ';user_id=' || o_custkey FROM orders
),
kept AS (
  SELECT *, CASE WHEN key % 5 = 2 THEN 'update' ELSE 'insert' END AS type FROM records
  WHERE key % 7 <> 6 AND key % 11 <> 10 AND key % 5 IN (0, 1, 2)
),
routed AS (
  SELECT CASE t WHEN 'order_info' THEN CASE type WHEN 'insert' THEN 'kafka' ELSE 'clickhouse' END
                ELSE 'hbase' END AS sink_type,
         CASE t WHEN 'user_info' THEN 'dim_user_info' WHEN 'sku_info' THEN 'dim_sku_info'
                ELSE CASE type WHEN 'insert' THEN 'dwd_order_info' ELSE 'unused' END END AS sink_table,
         CAST(key AS VARCHAR) AS id,
         CASE WHEN t = 'order_info' AND type = 'update' THEN 'id=' || key ELSE pruned END AS data
  FROM kept WHERE NOT (t = 'sku_info' AND type = 'update')
)
"""

_PAGES = _with(PAGE_CTES)
_DETAIL = "CAST(l_extendedprice AS DECIMAL(20,2))"


def _gmv(keys: str) -> str:
    return f"""{_with(DIM_CTES)}
SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, {keys},
       CAST(sum({_DETAIL}) AS DOUBLE) AS order_amount
FROM lineitem LEFT JOIN sku ON l_partkey = sku_id GROUP BY ALL"""


SQL = {
    "gmv_day": f"""SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt,
       CAST(sum({_DETAIL}) AS DOUBLE) AS order_amount FROM lineitem GROUP BY ALL""",
    "gmv_on_date": f"""SELECT CAST(sum({_DETAIL}) AS DOUBLE) AS order_amount FROM lineitem
WHERE CAST(l_shipdate AS DATE) = DATE '1998-06-01'""",
    "gmv_by_brand": _gmv("tm_id, tm_name"),
    "gmv_by_category": _gmv("category3_id, category3_name"),
    "gmv_by_product": f"""{_with(DIM_CTES)},
per_sku AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, l_partkey AS sku_id, sum({_DETAIL}) AS amount,
         count(DISTINCT l_orderkey) AS orders
  FROM lineitem GROUP BY ALL
)
SELECT dt, spu_id, spu_name, CAST(sum(amount) AS DOUBLE) AS order_amount, CAST(sum(orders) AS BIGINT) AS order_ct
FROM per_sku LEFT JOIN sku USING (sku_id) GROUP BY ALL""",
    "province_amount": f"""{_with(WIDE_CTES, DIM_CTES, PROVINCE_CTES)}
SELECT left(stt, 10) AS dt, province_name, CAST(sum(amount) AS DOUBLE) AS order_amount,
       CAST(sum(order_count) AS BIGINT) AS order_count
FROM province_totals GROUP BY ALL""",
    "visitor_by_hour_dense": f"""{_with(PAGE_CTES, VISITOR_CTES)},
hourly AS (
  SELECT strftime(et, '%Y-%m-%d') AS dt, hour(et) AS h, sum(pv) AS pv, sum(uv) AS uv, sum(uj) AS uj
  FROM visits GROUP BY ALL
),
slots AS (SELECT DISTINCT dt, CAST(i AS INTEGER) AS hour FROM hourly, range(24) r(i))
SELECT s.dt, s.hour, CAST(coalesce(pv, 0) AS BIGINT) AS pv, CAST(coalesce(uv, 0) AS BIGINT) AS uv,
       CAST(coalesce(uj, 0) AS BIGINT) AS uj
FROM slots s LEFT JOIN hourly h ON s.dt = h.dt AND s.hour = h.h""",
    "keyword_score": f"""{_INTERACTIONS}, {PRODUCT_WORD_CTES}, {_SEARCH},
scored AS (
  SELECT left(stt, 10) AS dt, keyword,
         ct * CASE source WHEN 'click' THEN 4 WHEN 'cart' THEN 6 ELSE 8 END AS score FROM product_words
  UNION ALL SELECT strftime(et, '%Y-%m-%d'), keyword, 2 FROM searched
)
SELECT dt, keyword, CAST(sum(score) AS BIGINT) AS score FROM scored GROUP BY ALL""",
    "new_visitor_flag": f"""{_PAGES}
SELECT event_id, mid, ts, CASE WHEN rn = 1 THEN 1 ELSE 0 END AS is_new FROM ranked""",
    "daily_unique_visitor": f"{_PAGES} SELECT event_id, mid, ts FROM ranked WHERE rn_day = 1",
    "user_jump": f"{_PAGES} SELECT event_id, mid, ts FROM ranked WHERE {_JUMP} OR next_type = 'signup')",
    "user_jump_timeout_only": f"{_PAGES} SELECT event_id, mid, ts FROM ranked WHERE {_JUMP})",
    "latest_per_key": """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1""",
    "order_wide_interval": f"""{_with(WIDE_CTES)}
SELECT detail_id, order_id, sku_id, sku_num, CAST(split_coupon_amount AS DOUBLE) AS split_coupon_amount,
       CAST(split_total_amount AS DOUBLE) AS split_total_amount, province_id, order_status, user_id,
       CAST(total_amount AS DOUBLE) AS total_amount, CAST(0 AS DOUBLE) AS activity_reduce_amount,
       CAST(0 AS DOUBLE) AS coupon_reduce_amount, CAST(total_amount AS DOUBLE) AS original_total_amount,
       CAST(0 AS DOUBLE) AS feight_fee, {_text('o_orderdate')} AS create_time,
       strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour,
       epoch_ms(o_orderdate) AS ts
FROM owide""",
    "payment_wide_interval": f"""{_with(WIDE_CTES)}
SELECT order_id AS payment_id, {_text('pay_time')} AS payment_create_time,
       {_text('o_orderdate')} AS order_create_time, order_id, user_id,
       CAST(total_amount AS DOUBLE) AS total_amount, 'order' AS subject, o_orderpriority AS payment_type,
       {_text('pay_time')} AS callback_time, detail_id, sku_id, sku_num,
       CAST(split_coupon_amount AS DOUBLE) AS split_coupon_amount,
       CAST(split_total_amount AS DOUBLE) AS split_total_amount, province_id, order_status,
       CAST(0 AS DOUBLE) AS activity_reduce_amount, CAST(0 AS DOUBLE) AS coupon_reduce_amount,
       CAST(total_amount AS DOUBLE) AS original_total_amount, CAST(0 AS DOUBLE) AS feight_fee,
       epoch_ms(pay_time) AS ts
FROM pwide""",
    "dim_enrich": f"""{_with(WIDE_CTES, DIM_CTES)}
SELECT detail_id, order_id, sku_id, {_text('o_orderdate')} AS create_time,
       CAST(split_total_amount AS DOUBLE) AS split_total_amount, user_gender, {AGE} AS user_age,
       province_name, province_3166_2_code, province_area_code, province_iso_code, sku_name,
       CAST(sku_price AS DOUBLE) AS sku_price, spu_id, spu_name, tm_id, tm_name, category3_id, category3_name
FROM owide LEFT JOIN customers USING (user_id) LEFT JOIN province USING (province_id)
LEFT JOIN sku USING (sku_id)""",
    "dim_enrich_missing": f"""{_with(DIM_CTES)}
SELECT event_id, e.user_id, event_id * 3 AS sku_id, user_gender, sku_name,
       concat_ws(',', CASE WHEN c.user_id IS NULL THEN 'user' END,
                 CASE WHEN s.sku_id IS NULL THEN 'sku' END) AS missing
FROM events e LEFT JOIN customers c ON e.user_id = c.user_id LEFT JOIN sku s ON s.sku_id = event_id * 3""",
    "user_age": f"""{_with(DIM_CTES)}
SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(birthday, '%Y-%m-%d') AS "BIRTHDAY", {AGE} AS age FROM customers""",
    "visitor_stats": f"""{_with(PAGE_CTES, VISITOR_CTES)}
SELECT {_hour_bounds('et')}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct,
       CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
       CAST(sum(uj) AS BIGINT) AS uj_ct, CAST(sum(dur) AS BIGINT) AS dur_sum
FROM visits GROUP BY ALL""",
    "product_stats": f"""{_with(PAGE_CTES, WIDE_CTES, FACT_CTES, TOTAL_CTES, DIM_CTES)}
SELECT totals.*, sku_name, CAST(sku_price AS DOUBLE) AS sku_price, spu_id, spu_name, tm_id, tm_name,
       category3_id, category3_name
FROM totals LEFT JOIN sku USING (sku_id)""",
    "province_stats": f"""{_with(WIDE_CTES, DIM_CTES, PROVINCE_CTES)}
SELECT * EXCLUDE (amount), CAST(amount AS DOUBLE) AS order_amount FROM province_totals""",
    "search_keyword_count": f"""WITH {_SEARCH}
SELECT {_text("time_bucket(INTERVAL 5 SECOND, et) + INTERVAL 8 HOUR")} AS stt,
       {_text("time_bucket(INTERVAL 5 SECOND, et) + INTERVAL 8 HOUR + INTERVAL 5 SECOND")} AS edt,
       keyword, 'search' AS source, count(*) AS ct
FROM searched GROUP BY ALL""",
    "page_search_count": f"""{_PAGES},
found AS (SELECT et, {_WORDS.format('item')} AS keyword FROM pages
          WHERE page_id = 'good_list' AND item_type = 'keyword' AND item IS NOT NULL)
SELECT {_hour_bounds('et')}, keyword, 'search' AS source, count(*) AS ct FROM found GROUP BY ALL""",
    "product_keyword_sum": f"{_INTERACTIONS}, {PRODUCT_WORD_CTES} SELECT * FROM product_words",
    "lateral_keywords": f"{_INTERACTIONS}, {PRODUCT_WORD_CTES} SELECT * FROM product_words",
    "lateral_table_functions": f"""{_INTERACTIONS}, {PRODUCT_WORD_CTES}
SELECT form, product_words.* FROM product_words, (VALUES ('comma'), ('join')) f(form)""",
    "orders_by_brand_exact": f"""{_with(DIM_CTES)},
lines AS (
  SELECT l_orderkey, tm_id, epoch(CAST(l_shipdate AS TIMESTAMP))::BIGINT // 2592000 AS w
  FROM lineitem LEFT JOIN sku ON l_partkey = sku_id
), windows AS (SELECT tm_id, w, count(DISTINCT l_orderkey) AS n FROM lines GROUP BY ALL)
SELECT tm_id, order_ct, sum_of_windows
FROM (SELECT tm_id, count(DISTINCT l_orderkey) AS order_ct FROM lines GROUP BY ALL)
JOIN (SELECT tm_id, sum(n) AS sum_of_windows FROM windows GROUP BY ALL) USING (tm_id)""",
    "dynamic_records": f"""{_PAGES}
SELECT 'record' AS output, event_id AS tie, mid, ts, event_type AS tag, 'extra,kind' AS unknown,
       '{{"k":' || k || ',"tags":["' || event_type || '","x"]}}' AS extra FROM logs
UNION ALL SELECT 'reject', doc_id, NULL, length(text), NULL, NULL, NULL FROM documents""",
    "stamped_now": "SELECT event_id, true AS is_now FROM events",
    "literal_weights": """SELECT event_type AS kind,
       sum(CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 4 ELSE 8 END)::BIGINT AS score
FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL""",
    "log_split": f"""{_PAGES}
SELECT 'start' AS output, mid, ts, 'icon' AS name, CAST(NULL AS VARCHAR) AS item FROM logs WHERE event_type = 'error'
UNION ALL SELECT 'page', mid, ts, page_id, item FROM pages
UNION ALL SELECT 'display', mid, ts, page_id, item FROM shown""",
    "display_explode": f"""{_PAGES}
SELECT event_id, mid, vc, ch, ar, page_id, item, item_type, during_time, ts FROM shown""",
    "json_records": f"""{_PAGES}
SELECT event_id, '{{"mid":"' || mid || '","page_id":"' || page_id || '"'
       || coalesce(',"last_page_id":"' || last_page_id || '"', '') || ',"ts":' || ts || '}}' AS text,
       mid, page_id, last_page_id, ts FROM pages""",
    "log_rejects": f"""{_PAGES}
SELECT 'record' AS output, event_id AS tie, ts AS number FROM logs
UNION ALL SELECT 'reject', doc_id, length(text) FROM documents""",
    "product_rejects": f"""{_PAGES}, clicked AS (
  SELECT event_id % 7 <> 0 AS good FROM pages WHERE item_type = 'sku_id'
), carted AS (SELECT k % 5 <> 0 AS good FROM pages WHERE event_type = 'purchase')
SELECT CASE WHEN g THEN 'counted' ELSE 'rejected' END AS output,
       (SELECT count(*) FROM clicked WHERE good = g) AS click_ct,
       (SELECT count(*) FROM carted WHERE good = g) AS cart_ct
FROM (VALUES (true), (false)) t(g)""",
    "cdc_filter": f"""WITH {CHANGE_CTES}
SELECT t AS source_table, type, CAST(key AS VARCHAR) AS id, data FROM kept""",
    "column_prune": f"WITH {CHANGE_CTES} SELECT sink_table, id, data FROM routed",
    "config_route": f"""WITH {CHANGE_CTES}
SELECT sink_type, sink_table, 'id' AS sink_pk, id, data FROM routed WHERE sink_type <> 'clickhouse'""",
    "time_functions": f"""{_PAGES}
SELECT event_id, {_text('et')} AS time_text, ts // 1000 * 1000 AS millis,
       strftime(et, '%Y-%m-%d') AS day, strftime(et, '%Y-%m-%d') AS date_part, strftime(et, '%H') AS hour_part,
       CAST(strftime(et, '%Y%m%d') AS INTEGER) AS day_key, CAST(hour(et) AS INTEGER) AS hour,
       {_text('et + INTERVAL 8 HOUR')} AS shanghai_text,
       strftime(et + INTERVAL 8 HOUR, '%Y-%m-%d') AS shanghai_day FROM pages""",
    "text_functions": """SELECT event_id, event_id % 4 IN (0, 1) AS blank,
       CAST(CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 6 ELSE 8 END AS INTEGER) AS weight,
       CASE WHEN event_id % 2 = 1 THEN event_type END AS kind,
       CAST((event_id % 2 = 0)::INTEGER + (event_id % 3 = 0)::INTEGER AS INTEGER) AS kept,
       CASE WHEN event_id % 2 = 0 THEN '' ELSE 'x-' END || event_type AS plain FROM events""",
    "document_words": f"SELECT doc_id, {_WORDS.format('text')} AS word FROM documents",
    "source_unpivot": f"{_INTERACTIONS} SELECT stt, sku_id, source, ct FROM sources",
}

SQL |= {
    f"{name}_stream": SQL[name]
    for name in (
        "new_visitor_flag", "daily_unique_visitor", "user_jump", "user_jump_timeout_only",
        "order_wide_interval", "payment_wide_interval", "dim_enrich", "visitor_stats",
        "product_stats", "province_stats", "search_keyword_count", "product_keyword_sum",
        "display_explode",
    )
}
SQL["log_split_parts"] = SQL["log_split"]
SQL |= {
    "log_landing_stream": f"{_PAGES} SELECT mid, ts, page_id FROM logs",
    "routed_facts_stream": f"""WITH {CHANGE_CTES}
SELECT sink_table, data FROM routed WHERE sink_type = 'kafka'""",
    "log_split_stream": SQL["log_split"],
    "serving_stream": SQL["province_stats"],
    "upserted_dims_stream": """
SELECT CAST(c_custkey AS VARCHAR) AS id,
       c_name || CASE WHEN c_custkey % 2 = 1 THEN ' 3' ELSE ' 2' END AS name,
       CAST(c_nationkey AS VARCHAR) AS nation FROM customer""",
    "refreshed_lookup_stream": """
SELECT o_orderkey AS order_id, o_custkey AS user_id,
       c_name || CASE WHEN c_custkey % 2 = 1 THEN ' 3' ELSE ' 2' END AS user_name,
       CAST(c_nationkey AS VARCHAR) AS user_nation
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "routed_dims_stream": f"""WITH {CHANGE_CTES}
SELECT sink_table, id, coalesce(c_name, p_name) AS name FROM routed
LEFT JOIN customer ON sink_table = 'dim_user_info' AND id = CAST(c_custkey AS VARCHAR)
LEFT JOIN part ON sink_table = 'dim_sku_info' AND id = CAST(p_partkey AS VARCHAR)
WHERE sink_type = 'hbase'""",
}
