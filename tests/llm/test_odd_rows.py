"""Odd rows, empty tables and clashing columns, for every operator over documents."""

import pytest
from odd_rows import ODD, collected, no_documents, odd_documents, odd_labels
from pyspark.sql import functions as F

from tillwater.llm import (
    ctw, decontamination, licenses, mixing, quality, repeats, simhash, toxicity)


def benchmark(spark):
    return spark.createDataFrame(
        [(1, ODD[0][1]), (2, None), (None, "a b c d e f g h i j"), (3, ""), (1, ODD[0][1])],
        "item_id long, text string")


OPERATORS = {
    "ctw": lambda s, d: ctw.score_held_out(d, depth=3),
    "decontamination": lambda s, d: decontamination.contaminated(d, benchmark(s)),
    "toxicity": lambda s, d: toxicity.classify(d, odd_labels(s, "toxic")),
    "repeats": lambda s, d: repeats.without_repeats(d),
    "shortened": lambda s, d: repeats.shortened(d).select(*[f.name for f in s_fields(d)]),
    "mixing": lambda s, d: mixing.mix(d, mixing.domain_of(F.col("source"))).select(
        "doc_id", "lang", "n_tokens", "n_copies"),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "quality": lambda s, d: quality.classify(d, odd_labels(s, "quality")),
    "licenses": lambda s, d: licenses.scan_licenses(d),
}
ROW_EACH = [n for n in OPERATORS if n != "decontamination"]


def s_fields(docs):
    return [f for f in docs.schema.fields if f.name in ("doc_id", "text", "n_chars")]


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(spark, name):
    plain = collected(OPERATORS[name](spark, odd_documents(spark)))
    clashing = collected(OPERATORS[name](spark, odd_documents(spark, clashing=True)))
    assert rounded(plain) == rounded(clashing)
    if name in ROW_EACH:
        assert len(plain) == len(ODD)


def rounded(rows):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows]


@pytest.mark.parametrize("name", OPERATORS)
def test_no_documents(spark, name):
    assert OPERATORS[name](spark, no_documents(spark)).collect() == []


def test_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    for frame in (
        quality.classify(odd_documents(spark), none), toxicity.classify(odd_documents(spark), none)):
        assert all(0 <= r["score"] <= 1 for r in frame.collect())


def test_no_benchmark(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(odd_documents(spark), none).collect() == []


def test_shortened_keeps_columns(spark):
    docs = odd_documents(spark, clashing=True)
    short = repeats.shortened(docs)
    assert short.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in short.collect()}[5] == ""
