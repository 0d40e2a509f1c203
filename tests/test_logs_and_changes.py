"""Parsing, log splitting, change cleaning and routing."""

import json

from pyspark.sql import functions as F

from conftest import rows
from tillwater import schemas
from tillwater.operators.changes import clean_changes, dims, facts, match_routes, route
from tillwater.operators.logs import split_log
from tillwater.operators.parsing import parse_json, to_json_text
from tillwater.sources import literal_records


def records(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_broken_texts_are_kept_aside(spark):
    raw = records(spark, '{"ts": 1}', "{broken", "", None, "null", '{"ts": "x"}')
    good, rejects = parse_json(raw, schemas.LOG)
    assert rows(good, "ts") == [(1,)]
    assert rejects.count() == 5


def test_a_text_is_parsed_once(spark):
    raw = records(spark, '{"ts": 1, "start": {"entry": "icon"}}')
    good, _ = parse_json(raw, schemas.LOG)
    plan = good.filter(F.col("start").isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_json_out_leaves_absent_fields_out(spark):
    frame = spark.createDataFrame([("t", 1, None)], "topic string, a long, b string")
    assert rows(to_json_text(frame, keep=["topic"])) == [("t", '{"a":1}')]


def log(spark, *logs):
    return parse_json(literal_records(spark, list(logs)), schemas.LOG)[0]


def test_page_with_two_displays(spark):
    start, page, display = split_log(log(spark, {
        "common": {"mid": "1"}, "page": {"page_id": "home"},
        "displays": [{"item": "a", "item_type": "sku_id"}, {"item": "b", "item_type": "x"}], "ts": 5,
    }))
    assert (start.count(), page.count(), display.count()) == (0, 1, 2)
    assert rows(display, "mid", "page_id", "item", "ts") == [("1", "home", "a", 5), ("1", "home", "b", 5)]


def test_start_wins_and_neither_is_dropped(spark):
    outputs = split_log(log(
        spark,
        {"start": {"entry": "icon"}, "page": {"page_id": "home"}, "displays": [{"item": "a"}], "ts": 1},
        {"common": {"mid": "1"}, "ts": 2},
    ))
    assert [o.count() for o in outputs] == [1, 0, 0]


def test_later_parts_win_but_absent_fields_hide_nothing(spark):
    _, _, display = split_log(log(
        spark,
        {"page": {"page_id": "p", "item": "page item", "item_type": "keyword"},
         "displays": [{"item": "own", "item_type": "sku_id"}], "ts": 1},
        {"page": {"page_id": "p"}, "displays": [{"item": "own", "item_type": "sku_id"}], "ts": 2},
        {"displays": [{"item": "no page", "item_type": "sku_id"}], "ts": 3},
    ))
    assert rows(display, "ts", "item", "item_type") == [
        (1, "page item", "keyword"), (2, "own", "sku_id"), (3, "no page", "sku_id"),
    ]


def change(type="insert", data={"id": 1}, database="shop", table="user_info"):
    return json.dumps({"database": database, "table": table, "type": type, "data": data, "ts": 1})


def test_change_cleaning(spark):
    raw = records(
        spark, change("bootstrap-insert"), change("insert"), change("update"),
        change("bootstrap-start"), change("delete"), change(data={}), change(data=None),
        change(database="other"), change(table=None),
        change(data={"id": 9, "note": "a bootstrap-insert in the data"}),
    )
    kept = clean_changes(parse_json(raw, schemas.CHANGE)[0], "shop")
    assert rows(kept, "type") == [("insert",)] * 3 + [("update",)]
    notes = kept.filter("data['id'] = '9'").select(F.col("data")["note"]).first()[0]
    assert notes == "a bootstrap-insert in the data"


def config(spark):
    return spark.createDataFrame(
        [("user_info", "insert", "hbase", "dim_user", "id,name", None, None),
         ("order_info", "insert", "kafka", "dwd_order", "id", None, None),
         ("user_info", "update", "clickhouse", "x", "id", None, None)],
        schemas.ROUTES,
    )


def test_routing(spark):
    raw = records(
        spark, change(data={"id": 1, "name": "n", "secret": "s"}), change("update"),
        change(table="order_info", data={"id": 2, "name": "n"}), change(table="unknown"),
    )
    cleaned = clean_changes(parse_json(raw, schemas.CHANGE)[0], "shop")
    assert match_routes(cleaned, config(spark)).count() == 3
    routed = route(cleaned, config(spark))
    assert rows(dims(routed), "sink_table", "sink_pk", F.to_json("data")) == [
        ("dim_user", "id", '{"id":"1","name":"n"}')
    ]
    assert rows(facts(routed), "sink_table", F.to_json("data")) == [("dwd_order", '{"id":"2"}')]

