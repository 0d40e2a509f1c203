"""Late rows, waiting facts, seeded state, early results and config feeds over waves of input."""

import datetime as dt
import json
import os
import time

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows, visits
from test_streaming import DAY, FAR, drain, page_logs, write_batches
from tillwater import schemas
from tillwater.operators import measures as m, stats
from tillwater.operators.changes import clean_changes, match_routes, route, route_history
from tillwater.operators.firsts import flag_new_visitors
from tillwater.plans.feeds import Waves, _closing
from tillwater.plans.queries import data_text
from tillwater.sinks import hidden, once_sink, read_once, read_updated, updating_sink
from tillwater.sinks.once import OnceWriter, Written
from tillwater.sources import file_stream, read_route_feed
from tillwater.streaming.answers import answered
from tillwater.streaming.firsts import (
    daily_unique_stream, flag_new_visitors_stream, seen_by)
from tillwater.streaming.late import with_late
from tillwater.streaming.runner import start, stopped_at
from tillwater.streaming.state import state_variable

T0 = dt.datetime(2024, 3, 1)


def seconds(n):
    return T0 + dt.timedelta(seconds=n)


# --- late rows --------------------------------------------------------------


def test_counted_and_late_rows_are_the_input(spark, folder):
    records = [("a", 100_000, None), ("a", 200_000, None), ("a", 1_000, None), ("a", 1_000, None),
               ("b", 99_000, "home"), ("a", 179_999, "home"), ("a", 180_001, None), FAR]
    logs = page_logs(visits(spark, records))
    write_batches(logs, f"{folder}/in", [[0, 1], [2, 3, 4, 5, 6], [7]])
    stream = file_stream(spark, f"{folder}/in", logs.schema, files_per_batch=1)
    out = drain(spark, stats.visitor_sums_and_late([m.page_views(stream)]), folder)
    counted, late = out.filter("late_row IS NULL"), out.filter("late_row IS NOT NULL")
    # The watermark is at 180 s: 99, 1 and 1 s are late, 179.999 is in the window up to 180.
    assert rows(late, "stt", "pv_ct", "late_count") == [
        ("1970-01-01 00:00:00", 2, 2), ("1970-01-01 00:01:35", 1, 1),
        ("1970-01-01 00:02:55", 1, 1)]
    assert sum(r["pv_ct"] for r in out.collect()) == 7
    # Added to the serving table they give what the batch form gives.
    keys = ["stt", "edt", *m.VISITOR_KEYS]
    whole = with_late(counted, late, keys, list(m.VISITOR_MEASURES))
    real = logs.filter("mid <> 'closing'")
    assert rows(whole) == rows(stats.visitor_sums([m.page_views(real)]).select(*whole.columns))


# --- new visitors -----------------------------------------------------------


def test_no_record_is_lost_after_a_quiet_time(spark, folder):
    records = [("a", DAY, None), ("b", DAY + 1_000, None), ("a", DAY + 2_000, "p"),
               ("a", 31 * DAY, None), ("c", 31 * DAY + 500, None), ("b", 62 * DAY, "p"), FAR]
    frame = visits(spark, records)
    write_batches(frame, f"{folder}/in", [[0, 1, 2], [3, 4], [5], [6]])
    pages = file_stream(spark, f"{folder}/in", frame.schema, files_per_batch=1)
    got = drain(spark, flag_new_visitors_stream(
        pages.withWatermark("et", "3 seconds"), "mid", "et", "tie"), folder)
    want = flag_new_visitors(frame.filter("mid <> 'closing'"), "mid", "et", "tie")
    assert rows(got.filter("mid <> 'closing'"), "tie", "mid", "et", "is_new") == rows(
        want, "tie", "mid", "et", "is_new")


def test_late_records_leave_with_zero(spark, folder):
    records = [("a", 100_000, None), ("b", 101_000, None), ("new", 1_000, None),
               ("a", 2_000, None), FAR]
    frame = visits(spark, records)
    write_batches(frame, f"{folder}/in", [[0], [1], [2, 3], [4]])
    pages = file_stream(spark, f"{folder}/in", frame.schema, files_per_batch=1)
    got = drain(spark, flag_new_visitors_stream(
        pages.withWatermark("et", "3 seconds"), "mid", "et", "tie"), folder)
    assert rows(got.filter("tie < 4"), "tie", "is_new") == [(0, 1), (1, 1), (2, 0), (3, 0)]


def test_state_starts_from_earlier_runs(spark, folder):
    frame = visits(spark, [("a", DAY, None), ("b", DAY, None), ("a", 2 * DAY, None),
                           ("b", 3 * DAY, None), FAR])
    write_batches(frame, f"{folder}/in", [[0, 1], [2], [3], [4]])

    def pages():
        return file_stream(
            spark, f"{folder}/in", frame.schema, files_per_batch=1).withWatermark("et", "3 seconds")

    seen = spark.createDataFrame([("a",), ("a",), ("z",)], "mid string")
    got = drain(spark, flag_new_visitors_stream(
        pages(), "mid", "et", "tie", seen=seen), f"{folder}/new")
    want = flag_new_visitors(
        frame.filter("mid <> 'closing'"), "mid", "et", "tie", seen=seen)
    assert rows(got.filter("tie < 4"), "tie", "is_new") == rows(want, "tie", "is_new")
    days = spark.createDataFrame(
        [("a", dt.date(1970, 1, 2)), ("b", dt.date(1970, 1, 1))], "mid string, day date")
    unique = drain(spark, daily_unique_stream(
        pages(), "mid", "et", "tie", seen=days), f"{folder}/unique")
    assert rows(unique.filter("tie < 4"), "tie") == [(1,), (2,), (3,)]


def test_a_new_checkpoint_goes_on_from_an_old_ones_state(spark, folder):
    frame = visits(spark, [
        ("a", DAY, None), ("b", DAY + 1_000, None), ("b", 3 * DAY, None), ("x", 4 * DAY, None),
        ("a", 4 * DAY + 9_000, None), ("c", 4 * DAY + 9_000, None), ("b", 4 * DAY + 9_500, None),
        FAR])
    for part, batches in (("one", [[0, 1], [2], [3]]), ("two", [[4, 5, 6], [7]])):
        write_batches(frame, f"{folder}/{part}", batches)

    def flags(part, seen=None, partitions=2):
        pages = file_stream(spark, f"{folder}/{part}", frame.schema, files_per_batch=1)
        return drain(spark, flag_new_visitors_stream(
            pages.withWatermark("et", "3 seconds"), "mid", "et", "tie", seen=seen),
            f"{folder}/flags-{part}", partitions)

    flags("one")
    offsets, watermark = stopped_at(spark, f"{folder}/flags-one/checkpoint")
    # The query reads its input twice: for first records and for all.
    assert offsets == ['{"logOffset":2}'] * 2 and watermark == 4 * DAY - 3_000
    seen = seen_by(spark, f"{folder}/flags-one/checkpoint", "mid")
    assert rows(seen, "mid", "day") == [("a", None), ("b", None)]
    assert rows(flags("two", seen, 5).filter("tie < 7"), "tie", "is_new") == [
        (4, 0), (5, 1), (6, 0)]
    with pytest.raises(ValueError):
        state_variable(spark, f"{folder}/flags-one/checkpoint", "nothing")


def test_days_seen_by_an_old_checkpoint(spark, folder):
    frame = visits(spark, [
        ("a", DAY, None), ("b", DAY + 1_000, None), ("x", DAY + 60_000, None),
        ("a", DAY + 90_000, None), ("c", DAY + 90_000, None), ("b", 2 * DAY, None), FAR])
    for part, batches in (("one", [[0, 1], [2]]), ("two", [[3, 4, 5], [6]])):
        write_batches(frame, f"{folder}/{part}", batches)

    def unique(part, seen=None):
        pages = file_stream(spark, f"{folder}/{part}", frame.schema, files_per_batch=1)
        return drain(spark, daily_unique_stream(
            pages.withWatermark("et", "3 seconds"), "mid", "et", "tie", seen=seen),
            f"{folder}/unique-{part}")

    unique("one")
    seen = seen_by(spark, f"{folder}/unique-one/checkpoint", "mid")
    assert rows(seen) == [("a", dt.date(1970, 1, 2)), ("b", dt.date(1970, 1, 2))]
    assert rows(unique("two", seen).filter("tie < 6"), "tie") == [(4,), (5,)]


# --- facts that wait --------------------------------------------------------

FACTS = "id long, k string, et timestamp, more struct<x:string>"
ROWS = "k string, name string, changed timestamp, place long"


@pytest.mark.parametrize("spread", [1, 5])
def test_facts_wait_for_their_row(spark, spread):
    facts = lambda *given: spark.createDataFrame(
        [(i, k, seconds(s), (f"x{i}",)) for i, k, s in given], FACTS)
    table = lambda *given: spark.createDataFrame(
        [(k, n, seconds(s), p) for k, n, s, p in given], ROWS)
    waves = Waves(spark, "waits", facts=facts((0, "a", 0)).schema, table=table(("a", "", 0, 0)).schema)
    stream = waves.stream("facts").withWatermark("et", "10 seconds")
    met = answered(
        stream.withColumn("et", F.timestamp_micros(F.unix_micros("et"))), F.col("k"), F.col("et"),
        F.col("et") + F.expr("INTERVAL 60 SECONDS"), waves.stream("table"), F.col("k"),
        (F.col("changed"), F.col("place")), lifetime="200 seconds", spread=spread)
    for new_facts, new_rows in (
        # Known at once; the newer of two changes, whatever their order; unknown; null key.
        (facts((1, "a", 0), (2, "b", 1), (3, "c", 2), (4, None, 3)),
         table(("a", "new", 0, 2), ("a", "old", 0, 1))),
        # b comes; an older change of a counts for nothing; c is out of time.
        (facts((5, "a", 70)), table(("b", "bee", 1, 1), ("a", "older", -5, 9))),
        (facts((6, "c", 100), (7, "a", 110)), table(("a", "newest", 90, 1))),
        # c's row comes too late for 3 and in time for 6; a's last row has ended by 300.
        (facts((8, "a", 300), (9, "b", 5)), table(("c", "sea", 0, 1))),
        (_closing(facts((0, "a", 0)), id=-1, k="end", et=dt.datetime(2200, 1, 1)), table()),
    ):
        waves.add(facts=new_facts, table=new_rows)
        out = waves.to_rows(met)
    found = rows(
        out.filter("id > 0"), "id", "k", "more.x", F.col("answer.name").alias("name"), "outcome")
    assert found == [
        (1, "a", "x1", "new", "met"), (2, "b", "x2", "bee", "met"),
        (3, "c", "x3", None, "waited out"), (4, None, "x4", None, "waited out"),
        (5, "a", "x5", "new", "met"), (6, "c", "x6", "sea", "met"),
        (7, "a", "x7", "newest", "met"), (8, "a", "x8", None, "waited out"),
        (9, "b", "x9", "bee", "met")]


# --- early results ----------------------------------------------------------


def test_open_windows_show_and_end_as_the_append_form(spark, folder):
    texts = lambda *given: spark.createDataFrame(
        [(t, seconds(s)) for t, s in given], "kw string, et timestamp")
    waves = Waves(spark, "early", texts=texts(("a", 0)).schema)
    counts = stats.search_keywords(waves.stream("texts"))
    keys = ["stt", "edt", "keyword", "source"]
    path, given = f"{folder}/table", []
    for wave in (texts(("a b", 0), ("a", 1)), texts(("b", 2), ("c", 7)), texts(("c d", 8))):
        given.append(wave)
        waves.add(texts=wave)
        waves.run(lambda df: updating_sink(df, path, keys, compact_every=2, grace="0 seconds"), counts)
        so_far = given[0]
        for more in given[1:]:
            so_far = so_far.unionByName(more)
        want = stats.search_keywords(so_far)
        assert rows(read_updated(spark, path, keys), *want.columns) == rows(want)
    wanted = want.filter("keyword = 'c'").select(*keys)
    assert rows(read_updated(spark, path, keys, wanted), "keyword", "ct") == [("c", 2)]


# --- append once ------------------------------------------------------------


def test_a_failed_and_retried_batch_appends_each_row_once(spark, folder):
    """Half of the tasks write their files before one fails; then the query goes on."""
    rows_in = spark.range(0, 4_000, 1, 4).withColumn("left_out", F.lit("x"))
    rows_in.write.parquet(f"{folder}/in")
    stream = file_stream(spark, f"{folder}/in", rows_in.schema)
    marker = f"{folder}/mended"

    def fails_late(batches):
        for batch in batches:
            if 3_500 in batch.column(0).to_pylist() and not os.path.exists(marker):
                time.sleep(2)
                raise RuntimeError("lost a task")
            yield batch

    def run_once(checkpoint="checkpoint"):
        out = stream.mapInArrow(fails_late, stream.schema).select(
            "id", hidden(F.col("left_out"), "left_out"))
        start(spark, once_sink(out, f"{folder}/out"), f"{folder}/{checkpoint}", drain=True
              ).awaitTermination()

    schema = stream.select("id").schema
    with pytest.raises(StreamingQueryException):
        run_once()
    assert read_once(spark, f"{folder}/out", schema).count() == 0
    with open(marker, "w"):
        pass
    run_once()
    assert rows(read_once(spark, f"{folder}/out", schema)) == rows(rows_in.select("id"))
    # Going on without new input adds nothing; another query counts its batches itself.
    run_once()
    run_once("checkpoint-2")
    assert read_once(spark, f"{folder}/out", schema).count() == 8_000


def test_a_batch_committed_twice_counts_once(folder):
    writer = OnceWriter(f"{folder}/out", "run")
    first, second = (writer.write(iter([pa.record_batch({"id": [1, 2]})])) for _ in range(2))
    writer.commit([first, Written(None, 0)], 7)
    writer.commit([second, None], 7)
    with open(f"{folder}/out/_commits/run-7.json") as file:
        assert json.load(file) == {"run": "run", "batch": 7, "files": [first.file], "rows": 2}
    assert os.listdir(f"{folder}/out/data") == [first.file]


# --- config as a feed -------------------------------------------------------


def feed(spark, *given):
    return spark.createDataFrame(
        [("t", "insert", "kafka", sink, columns, None, None, op, ts, tie)
         for sink, columns, op, ts, tie in given], schemas.ROUTE_FEED)


def test_a_route_holds_from_its_change_to_the_next(spark, folder):
    config = feed(
        spark, ("one", "id", "r", 10, 0), ("two", "id,x", "u", 20, 1), ("gone", "id", "u", 30, 2),
        ("three", "id", "u", 30, 3), ("three", "id", "d", 40, 4), ("four", "x", "c", 50, 5))
    changes = spark.createDataFrame(
        [("shop", "t", kind, {"id": str(ts), "x": "y"}, ts)
         for ts in (5, 19, 20, 29, 30, 39, 40, 49, 50, 99)
         for kind in ("insert", "update")], schemas.CHANGE)
    routed = route(clean_changes(changes, "shop"), route_history(config))
    assert rows(routed, "ts", "sink_table", data_text()) == sorted([
        (5, "one", "id=5"), (19, "one", "id=19"),
        (20, "two", "id=20;x=y"), (29, "two", "id=29;x=y"),
        (30, "three", "id=30"), (39, "three", "id=39"),
        (50, "four", "x=y"), (99, "four", "x=y")], key=str)
    # Without a snapshot nothing holds before the first change.
    history = route_history(config.filter("op <> 'r'"))
    assert match_routes(changes, history).agg(F.min("ts")).first()[0] == 20
    config.write.json(f"{folder}/config")
    assert rows(read_route_feed(spark, f"{folder}/config")) == rows(route_history(config))
    assert route_history(config.limit(0)).count() == 0
