"""Streaming forms against their batch forms, over several micro-batches."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from conftest import rows, visits
from tillwater.operators import measures as m, stats
from tillwater.operators.firsts import daily_unique, flag_new_visitors
from tillwater.operators.jumps import TIMEOUT_ONLY, user_jump
from tillwater.operators.wide import order_wide
from tillwater.plans.layers import timed_logs
from tillwater.session import STATE_SETTINGS, UNCOUNTED, UNSETTLED
from tillwater.sinks import file_sink, memory_sink
from tillwater.sources import file_stream
from tillwater.streaming.firsts import daily_unique_stream, flag_new_visitors_stream
from tillwater.streaming.runner import LateRows, start, start_split

DAY = 86_400_000
FAR = ("closing", 20_000 * DAY, None)


def write_batches(frame, folder, batches):
    """One file per batch, in order."""
    for ties in batches:
        frame.filter(F.col("tie").isin(ties)).coalesce(1).write.mode("append").parquet(folder)


def drain(spark, df, folder, partitions=2):
    query = start(
        spark, file_sink(df, f"{folder}/out"), f"{folder}/checkpoint", drain=True,
        state_partitions=partitions,
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def shuffled_visits(seed):
    """Two days of visits that arrive up to 2.9 s out of order, in four batches."""
    rnd = random.Random(seed)
    records, clock = [], DAY - 30_000
    for _ in range(60):
        clock += rnd.choice([300, 700, 1_200, 2_500, 5_000, 6_000])
        records.append((rnd.choice("abc"), clock, rnd.choice([None, "", "p", "q"])))
    arrival = sorted(range(60), key=lambda i: records[i][1] + rnd.randint(0, 2_900))
    return records + [FAR], [arrival[:10], arrival[10:35], arrival[35:], [60]]


def test_first_records_and_jumps_equal_their_batch_forms(spark, folder):
    records, batches = shuffled_visits(1)
    frame = visits(spark, records)
    write_batches(frame, f"{folder}/in", batches)
    real = frame.filter("mid <> 'closing'")
    entry = F.coalesce("last", F.lit("")) == ""

    def pages():
        source = file_stream(spark, f"{folder}/in", frame.schema, files_per_batch=1)
        return source.withWatermark("et", "3 seconds")

    got = drain(spark, flag_new_visitors_stream(pages(), "mid", "et", "tie"), f"{folder}/new")
    want = flag_new_visitors(real, "mid", "et", "tie")
    assert rows(got, "tie", "mid", "et", "is_new") == rows(want, "tie", "mid", "et", "is_new")

    got = drain(spark, daily_unique_stream(pages(), "mid", "et", "tie"), f"{folder}/unique")
    assert rows(got) == rows(daily_unique(real, "mid", "et", "tie"))
    assert got.count() == 6

    for mode in ("entry_or_timeout", TIMEOUT_ONLY):
        jumps = user_jump(pages(), "mid", "et", entry, "tie", mode=mode)
        got = drain(spark, jumps, f"{folder}/{mode}")
        assert rows(got) == rows(user_jump(real, "mid", "et", entry, "tie", mode=mode))


def test_a_restart_goes_on_where_it_stopped(spark, folder):
    records, batches = shuffled_visits(3)
    frame = visits(spark, records)

    def run():
        pages = file_stream(spark, f"{folder}/in", frame.schema, files_per_batch=1)
        unique = daily_unique_stream(pages.withWatermark("et", "3 seconds"), "mid", "et", "tie")
        return drain(spark, unique, folder)

    write_batches(frame, f"{folder}/in", batches[:2])
    run()
    write_batches(frame, f"{folder}/in", batches[2:])
    want = daily_unique(frame.filter("mid <> 'closing'"), "mid", "et", "tie")
    assert rows(run()) == rows(want)


def test_day_state_ends_with_the_day(spark, folder):
    """The same visitor on days far apart; the state in between is dropped."""
    frame = visits(spark, [("a", 0, None), ("b", 6 * DAY, None), ("a", 7 * DAY, None), FAR])
    write_batches(frame, f"{folder}/in", [[0], [1], [2], [3]])
    pages = file_stream(spark, f"{folder}/in", frame.schema, files_per_batch=1)
    unique = daily_unique_stream(pages.withWatermark("et", "3 seconds"), "mid", "et", "tie")
    query = start(
        spark, file_sink(unique, f"{folder}/out"), f"{folder}/checkpoint", drain=True,
        state_partitions=1,
    )
    query.awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    assert rows(out, "mid", "et") == rows(frame.filter("mid <> 'closing'"), "mid", "et")
    stored = [
        op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]
        if "transformWithState" in op["operatorName"]
    ]
    assert stored and stored[-1] < max(stored)


def page_logs(frame):
    common = F.struct(
        "mid", F.lit("v").alias("vc"), F.lit("c").alias("ch"), F.lit("a").alias("ar"),
        F.lit("0").alias("is_new"),
    )
    page = F.struct(
        F.lit("home").alias("page_id"), F.col("last").alias("last_page_id"),
        F.lit("3").alias("item"), F.lit("sku_id").alias("item_type"),
        F.lit(7).cast("long").alias("during_time"),
    )
    return frame.select("tie", "mid", "ts", common.alias("common"), page.alias("page"))


def test_windowed_statistics_equal_their_batch_forms(spark, folder):
    records, batches = shuffled_visits(4)
    logs = page_logs(visits(spark, records))
    write_batches(logs, f"{folder}/in", batches)
    real = logs.filter("mid <> 'closing'")

    def orders(df):
        """The visits as order lines, several to an order."""
        return df.select(
            F.lit(3).cast("long").alias("sku_id"), (F.col("tie") % 7).alias("order_id"),
            F.lit(2).cast("long").alias("sku_num"),
            F.lit(5).cast("decimal(20,2)").alias("split_total_amount"), "ts",
        )

    def both(build):
        stream = file_stream(spark, f"{folder}/in", logs.schema, files_per_batch=1)
        name = build.__name__
        assert rows(drain(spark, build(stream), f"{folder}/{name}")) == rows(build(real))

    def visitors(df):
        return stats.visitor_stats(df, df.filter("tie % 3 = 0"), df.filter("tie % 4 = 0"))

    def products(df):
        return stats.product_stats([m.clicks(df), m.orders(orders(df)), m.payments(orders(df))])

    both(visitors)
    both(products)


def test_late_rows_are_dropped_and_counted(spark, folder):
    logs = page_logs(visits(spark, [("a", 100_000, None), ("a", 200_000, None), ("a", 1_000, None), FAR]))
    write_batches(logs, f"{folder}/in", [[0], [1], [2], [3]])
    stream = file_stream(spark, f"{folder}/in", logs.schema, files_per_batch=1)
    counts = stats.visitor_stats(stream, stream, stream)
    late = LateRows()
    spark.streams.addListener(late)
    try:
        query = start(
            spark, file_sink(counts, f"{folder}/out"), f"{folder}/checkpoint", drain=True,
            state_partitions=1,
        )
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert rows(spark.read.parquet(f"{folder}/out"), "stt") == [
            ("1970-01-01 00:01:40",), ("1970-01-01 00:03:20",)
        ]
        deadline = time.time() + 20
        while not late.count(query) and time.time() < deadline:
            time.sleep(0.1)
        assert late.count(query) >= 1
    finally:
        spark.streams.removeListener(late)


def test_an_input_that_runs_ahead_makes_no_others_late(spark, folder):
    """Pages of all days are there in the first batch, jumps and uniques come later."""
    logs = page_logs(visits(spark, [("a", 100_000, None), ("a", 9 * DAY, None), FAR]))
    late = page_logs(visits(spark, [("a", 100_000, None), ("b", 100_500, None), FAR]))
    write_batches(logs, f"{folder}/page", [[0, 1, 2]])
    write_batches(late, f"{folder}/uv", [[0], [1], [2]])
    write_batches(late, f"{folder}/uj", [[0], [1], [2]])
    pages, uv, uj = (
        file_stream(spark, f"{folder}/{n}", logs.schema, files_per_batch=1)
        for n in ("page", "uv", "uj"))
    table = drain(spark, stats.visitor_stats(pages, uv, uj), folder, 1)
    totals = table.filter("stt < '1970-01-02'").agg(
        F.sum("pv_ct").alias("pv"), F.sum("uv_ct").alias("uv"), F.sum("uj_ct").alias("uj"))
    assert rows(totals, "pv", "uv", "uj") == [(1, 2, 2)]


def test_one_query_for_all_parts_of_the_log(spark, folder):
    """One source, one state; a batch that is written again replaces its own folder."""
    logs = page_logs(visits(spark, [("a", 1_000, None), ("a", 2_000, "home"), ("b", 3_000, None), FAR]))
    write_batches(logs, f"{folder}/in", [[0], [1], [2], [3]])
    stream = file_stream(spark, f"{folder}/in", logs.schema, files_per_batch=2)

    def split(batch):
        return {"entries": batch.filter("page.last_page_id IS NULL"), "all": batch}

    query = start_split(spark, stream, split, f"{folder}/out", f"{folder}/checkpoint", drain=True)
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out/all").count() == 4
    assert spark.read.parquet(f"{folder}/out/entries").count() == 3
    assert len({r["_run"] for r in spark.read.parquet(f"{folder}/out/all").collect()}) == 1


def test_a_long_backlog_of_one_visitor(spark, folder):
    """Thousands of pending windows of one visitor come to the state in many frames."""
    records = [("bot", 1_000 + 5_000 * i, None) for i in range(3_000)] + [FAR]
    logs = page_logs(visits(spark, records))
    logs.write.parquet(f"{folder}/in")
    stream = timed_logs(file_stream(spark, f"{folder}/in", logs.schema))
    flagged = flag_new_visitors_stream(stream, "mid", "et", "tie", "_new")
    out = drain(spark, flagged.select("mid", "ts", "_new"), folder)
    assert rows(out.filter("_new = 1 AND mid = 'bot'"), "ts") == [(1_000,)]
    assert out.filter("mid = 'bot'").count() == 3_000


def test_interval_join_on_streams(spark, folder):
    clock = lambda s: (dt.datetime(2022, 4, 1) + dt.timedelta(seconds=s)).strftime("%Y-%m-%d %H:%M:%S")
    far = 10**9
    orders = spark.createDataFrame(
        [(i, i, clock(20 * i)) for i in range(6)] + [(-1, -1, clock(far))],
        "id long, tie long, create_time string",
    )
    lines = spark.createDataFrame(
        [(10 * i + j, i, 10 * i + j, clock(20 * i + shift))
         for i in range(6) for j, shift in enumerate((-11, -10, 3, 10, 11))]
        + [(-1, -2, -1, clock(far))],
        "id long, order_id long, tie long, create_time string",
    )
    # Lines come ahead of some orders and after others.
    write_batches(orders, f"{folder}/orders", [[0, 1], [2, 3, 4], [5], [-1]])
    write_batches(lines, f"{folder}/lines", [list(range(0, 25)), list(range(25, 40)), list(range(40, 60)), [-1]])
    streams = [
        file_stream(spark, f"{folder}/{n}", f.schema, files_per_batch=1)
        for n, f in (("orders", orders), ("lines", lines))
    ]
    got = drain(spark, order_wide(*streams), f"{folder}/wide")
    want = order_wide(orders.filter("id >= 0"), lines.filter("id >= 0"))
    assert rows(got, "detail_id", "order_id") == rows(want, "detail_id", "order_id")
    assert got.count() == 18


def test_starting_leaves_the_session_as_it_was(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(3).write.parquet(f"{folder}/in")
    numbers = file_stream(spark, f"{folder}/in", spark.range(1).schema)
    query = start(
        spark, memory_sink(numbers), f"{folder}/checkpoint", name="numbers", drain=True,
        state_partitions=7,
    )
    query.awaitTermination()
    assert spark.table("numbers").count() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_an_inner_join_does_without_a_batch_for_its_old_state(spark, folder):
    """Nor does a drained query count its state rows, and the session stays as it was."""
    frame = visits(spark, [("a", 1_000, None), ("b", 2_000, None), FAR])
    frame.write.parquet(f"{folder}/in")
    left, right = (
        file_stream(spark, f"{folder}/in", frame.schema).withWatermark("et", "1 second").toDF(
            *[side + c for c in frame.columns]) for side in "lr")
    joined = left.join(right, (F.col("lmid") == F.col("rmid")) & F.col("ret").between(
        F.col("let") - F.expr("INTERVAL 1 SECOND"), F.col("let") + F.expr("INTERVAL 1 SECOND")))
    settings = {k: spark.conf.get(k, None) for k in (*STATE_SETTINGS, *UNCOUNTED, *UNSETTLED)}
    batches = {}
    for settle in (True, False):
        query = start(
            spark, file_sink(joined, f"{folder}/out-{settle}"), f"{folder}/checkpoint-{settle}",
            drain=True, state_partitions=1, count_state=False, settle=settle)
        query.awaitTermination()
        batches[settle] = [p["batchId"] for p in query.recentProgress]
        assert not any(op["numRowsTotal"] > 0 for p in query.recentProgress[:1]
                       for op in p["stateOperators"])
    assert rows(spark.read.parquet(f"{folder}/out-True")) == rows(
        spark.read.parquet(f"{folder}/out-False"))
    assert max(batches[True]) == 1 and max(batches[False]) == 0
    assert settings == {k: spark.conf.get(k, None) for k in settings}
