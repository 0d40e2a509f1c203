"""The answers of the queries over inputs that come in waves, in ANSI SQL."""

from __future__ import annotations

from tillwater.plans.oracle import CHANGE_CTES, PAGE_CTES, SQL, _hour_bounds, _with, _WORDS

_PAGES = _with(PAGE_CTES)
_HALF = "(SELECT (1 + max(doc_id)) / 2.0 FROM documents)"
_WORDS_BY_WINDOW = SQL["search_keyword_count"]

FEEDS_SQL = {
    "late_rows_stream": f"""{_PAGES},
passed AS (SELECT max(et) - INTERVAL 5 DAY AS mark FROM pages WHERE event_id % 10 <> 3),
seen AS (
  SELECT pages.*, event_id % 10 = 3 AND date_trunc('hour', et) + INTERVAL 1 HOUR
             <= to_timestamp(epoch_ms(mark) / 1000.0)::TIMESTAMP AS late,
         CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS sv
  FROM pages, passed
)
SELECT 'counted' AS output, {_hour_bounds('et')}, vc, ch, ar, is_new, count(*) AS pv_ct,
       sum(sv) AS sv_ct, sum(during_time) AS dur_sum, 0 AS late_count
FROM seen WHERE NOT late GROUP BY ALL
UNION ALL
SELECT 'late', stt, edt, vc, ch, ar, is_new, count(*), sum(sv), sum(during_time), count(*)
FROM (SELECT *, {_hour_bounds('et')} FROM seen WHERE late)
GROUP BY ts, stt, edt, vc, ch, ar, is_new, sv, during_time""",
    "new_visitor_seeded_stream": f"""{_PAGES}
SELECT event_id, mid, ts + CASE WHEN et >= TIMESTAMP '2024-01-16' THEN 40 * 86400000::BIGINT ELSE 0 END AS ts,
       CASE WHEN rn = 1 AND CAST(mid AS BIGINT) % 5 <> 0 THEN 1 ELSE 0 END AS is_new
FROM ranked""",
    "awaited_dims_stream": """WITH marks AS (
  SELECT max(o_orderdate) FILTER (o_orderkey % 2 = 0) - INTERVAL 1 DAY AS first,
         max(o_orderdate) - INTERVAL 1 DAY AS second FROM orders
), waits AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, c_name,
         c_name IS NOT NULL AND CASE o_custkey % 4
             WHEN 0 THEN true
             WHEN 1 THEN o_orderkey % 2 = 1 OR o_orderdate + INTERVAL 365 DAY > first
             WHEN 2 THEN o_orderdate + INTERVAL 365 DAY > second
             ELSE false END AS met
  FROM marks, orders LEFT JOIN customer ON c_custkey = o_custkey
)
SELECT order_id, user_id, CASE WHEN met THEN c_name END AS user_name,
       CASE WHEN met THEN 'met' ELSE 'waited out' END AS outcome FROM waits""",
    "routed_feed_stream": f"""WITH {CHANGE_CTES},
held AS (
  SELECT t, key, data, CASE
      WHEN t = 'user_info' AND key < 80 THEN 'dwd_user'
      WHEN t = 'user_info' THEN 'dwd_user_2'
      WHEN t = 'sku_info' AND key >= 60 THEN 'dwd_sku'
      WHEN t = 'order_info' AND key < 100 THEN 'dwd_order'
      WHEN t = 'order_info' AND key >= 300 THEN 'dwd_order_2' END AS sink_table
  FROM kept WHERE type = 'insert'
), wanted(sink_table, columns) AS (VALUES
  ('dwd_user', ['id', 'name']), ('dwd_user_2', ['id', 'segment']), ('dwd_sku', ['id', 'sku_name']),
  ('dwd_order', ['id', 'user_id']), ('dwd_order_2', ['id', 'status']))
SELECT sink_table, list_aggregate(list_filter(string_split(data, ';'),
           lambda x: list_contains(columns, string_split(x, '=')[1])), 'string_agg', ';') AS data
FROM held JOIN wanted USING (sink_table)""",
    "early_keywords_stream": f"""
SELECT 'end' AS shown, * FROM ({_WORDS_BY_WINDOW})
UNION ALL
SELECT 'half-way', * FROM ({_WORDS_BY_WINDOW.replace(
    'FROM documents', f'FROM documents WHERE doc_id < {_HALF}', 1)})""",
    "append_once_stream": f"""{_PAGES}
SELECT {_hour_bounds('et')}, vc, ch, ar, is_new, 0 AS uv_ct, count(*) AS pv_ct,
       sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS sv_ct, 0 AS uj_ct,
       sum(during_time) AS dur_sum
FROM pages GROUP BY ALL""",
    "memory_words_stream": f"""SELECT lang, count(*) AS n_words
FROM (SELECT doc_id, lang, {_WORDS.format('text')} AS word FROM documents) GROUP BY lang""",
    "late_dim_column_stream": SQL["upserted_dims_stream"],
}
# Going on from another query's state changes no answer.
FEEDS_SQL["redealt_state_stream"] = FEEDS_SQL["awaited_dims_stream"]
