import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillwater import functions as fn


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_durations():
    assert fn.micros("5 seconds") == 5_000_000
    assert fn.micros("-45 minutes") == -2_700_000_000
    assert fn.micros("1 day") == 86_400_000_000
    for bad in ("5", "five seconds", "5 fortnights"):
        with pytest.raises(ValueError):
            fn.micros(bad)


def test_millis_and_text(spark):
    ms = 1_648_813_805_000
    assert value(spark, fn.millis_to_text(F.lit(ms))) == "2022-04-01 11:50:05"
    assert value(spark, fn.text_to_millis(F.lit("2022-04-01 11:50:05"))) == ms
    assert value(spark, fn.text_to_millis(F.lit("soon"))) is None
    assert value(spark, fn.day_key(fn.millis_to_timestamp(F.lit(ms)))) == 20220401
    assert value(spark, fn.hour_of(fn.millis_to_timestamp(F.lit(ms)))) == 11


def test_zones(spark):
    late = fn.millis_to_timestamp(F.lit(1_648_828_800_000))  # 16:00 UTC
    assert value(spark, fn.local_text(late)) == "2022-04-01 16:00:00"
    assert value(spark, fn.local_text(late, "Asia/Shanghai")) == "2022-04-02 00:00:00"
    assert value(spark, fn.day_of(late, "Asia/Shanghai")) == dt.date(2022, 4, 2)


@pytest.mark.parametrize(
    "birthday, age",
    [("2000-01-01", 22), ("2021-01-02", 0), ("2021-01-01", 1), ("2022-01-01", 0), (None, None)],
)
def test_age_counts_365_day_years(spark, birthday, age):
    asof = F.lit(dt.datetime(2022, 1, 1))
    assert value(spark, fn.age_years(F.lit(birthday).cast("string"), asof)) == age


def test_date_arguments(spark):
    times = spark.createDataFrame(
        [("2022-03-31 23:59:59",), ("2022-04-01 00:00:00",), ("2022-04-01 23:59:59",), ("2022-04-02 00:00:00",)],
        "stt string",
    )
    for date in (20220401, "20220401", "2022-04-01", dt.date(2022, 4, 1), dt.datetime(2022, 4, 1, 5)):
        assert times.filter(fn.day_range("stt", date)).count() == 2
        typed = times.select(F.col("stt").cast("timestamp").alias("stt"))
        assert typed.filter(fn.day_range("stt", date)).count() == 2
    today = spark.createDataFrame([(dt.date.today().isoformat() + " 08:00:00",)], "stt string")
    assert today.filter(fn.day_range("stt", 0)).count() == 1
    assert today.filter(fn.day_range("stt", None)).count() == 1


def test_words_are_distinct_and_whole_texts_are_cut(spark):
    words = value(spark, fn.tokenize(F.lit("Red phone, RED phone-case; 4G Écran 小米")))
    assert words == ["red", "phone", "case", "4g", "écran", "小米"]
    assert value(spark, fn.tokenize(F.lit(" ,;"))) == []
    long = " ".join(f"w{i}" for i in range(20_000))
    assert len(value(spark, fn.tokenize(F.lit(long)))) == 20_000


def test_positive_measures_become_rows(spark):
    pairs = value(spark, fn.positive_sources(F.lit(1), F.lit(0), F.lit(3)))
    assert [tuple(p) for p in pairs] == [("click", 1), ("order", 3)]
    assert value(spark, fn.positive_sources(F.lit(None), F.lit(-1), F.lit(0))) == []


def test_map_functions(spark):
    data = F.create_map(F.lit("id"), F.lit("1"), F.lit("name"), F.lit("x"))
    assert value(spark, fn.keep_keys(data, F.lit("name,other"))) == {"name": "x"}
    # List entries are taken as they are, blanks included.
    assert value(spark, fn.keep_keys(data, F.lit("id, name"))) == {"id": "1"}
    assert value(spark, fn.upper_keys(data)) == {"ID": "1", "NAME": "x"}
    assert value(spark, fn.drop_bootstrap(F.lit("bootstrap-insert"))) == "insert"


def test_blank(spark):
    frame = spark.createDataFrame([(None,), ("",), (" ",)], "v string")
    assert rows(frame.select(fn.is_blank("v").alias("b"))) == [(False,), (True,), (True,)]


def test_source_weights(spark):
    frame = spark.createDataFrame([("search",), ("click",), ("cart",), ("order",)], "s string")
    assert rows(frame.select("s", fn.source_weight("s").alias("w"))) == [
        ("cart", 6), ("click", 4), ("order", 8), ("search", 2),
    ]
