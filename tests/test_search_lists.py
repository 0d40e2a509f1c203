"""Search words of a stream: a few state rows a window, and the counts of the batch form."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tillwater.operators import stats
from tillwater.sinks import file_sink
from tillwater.sources import file_stream
from tillwater.streaming.runner import start

T0 = dt.datetime(2024, 3, 1)
FAR = dt.datetime(2200, 1, 1)


def _counted(spark, folder, texts, words=stats.tokenize):
    """The stream's counts, its state rows after the first batch, and the batch form's counts."""
    texts.write.parquet(f"{folder}/in")
    end = spark.createDataFrame([("end", FAR)], texts.schema)
    end.write.mode("append").parquet(f"{folder}/in")
    stream = file_stream(spark, f"{folder}/in", texts.schema)
    query = start(
        spark, file_sink(stats.search_keywords(stream, words=words), f"{folder}/out"),
        f"{folder}/checkpoint", drain=True, state_partitions=2)
    query.awaitTermination()
    state = query.recentProgress[0]["stateOperators"][0]["numRowsTotal"]
    out = spark.read.parquet(f"{folder}/out").filter("stt < '2200'")
    return out, state, stats.search_keywords(texts, words=words)


def test_a_windows_words_share_a_few_state_rows(spark, folder):
    texts = spark.createDataFrame(
        [(" ".join(f"w{j}" for j in range(i % 7, 400, 1 + i % 3)), T0 + dt.timedelta(seconds=i))
         for i in range(30)] + [("", T0), (None, T0), ("w1", None)], "kw string, et timestamp")
    out, state, want = _counted(spark, folder, texts)
    assert rows(out) == rows(want) and out.count() > 2_000
    # Six windows and the closing row's.
    assert state <= 7 * 16


def test_lists_with_repeated_and_null_words(spark, folder):
    texts = spark.createDataFrame(
        [("b,a,b,-,a,b", T0), ("-,c", T0), ("a", T0 + dt.timedelta(seconds=9))],
        "kw string, et timestamp")
    words = lambda c: F.transform(
        F.split(c, ","), lambda w: F.when(w != "-", w))
    out, _, want = _counted(spark, folder, texts, words)
    assert rows(out, "stt", "keyword", "ct") == rows(want, "stt", "keyword", "ct")
    assert (None, 2) in rows(out, "keyword", "ct") and ("b", 3) in rows(out, "keyword", "ct")
