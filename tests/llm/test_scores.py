"""Context-tree scores, quality, toxicity and licenses against plain versions."""

import time
import collections
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from conftest import SF
from odd_rows import odd_documents, prose
from pyspark.sql import functions as F

from tillwater.llm import ctw, labelled, licenses, quality, queries, toxicity

SMALL = "/root/testdata/sf0.01"


def given(table, folder=SF):
    return duckdb.sql(f"SELECT * FROM '{folder}/{table}.parquet'").df()


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


class PlainTree:
    """Context-tree weighting with dictionaries."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.nodes = collections.defaultdict(lambda: [0, 0])
        for text in texts:
            for context, prefix, bit in self.decisions(text):
                for d in range(depth + 1):
                    self.nodes[context[depth - d :], prefix][bit] += 1
        self.weight, longer = {}, collections.defaultdict(float)
        for context, prefix in sorted(self.nodes, key=lambda k: -len(k[0])):
            zeros, ones = self.nodes[context, prefix]
            own = (math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi)
                   - math.lgamma(zeros + ones + 1))
            if len(context) == depth:
                mixed, self.weight[context, prefix] = own, 1.0
            else:
                more = longer[context, prefix]
                mixed = np.logaddexp(own, more) - math.log(2)
                self.weight[context, prefix] = 1 / (1 + math.exp(min(700, more - own)))
            if context:
                longer[context[1:], prefix] += mixed

    def decisions(self, text):
        line = b"\0" * self.depth + text.encode().lower() + b"\xff"
        for at in range(self.depth, len(line)):
            for k in range(8):
                yield line[at - self.depth : at], (1 << k) | line[at] >> (8 - k), \
                    line[at] >> (7 - k) & 1

    def bits(self, text):
        total = 0.0
        for context, prefix, bit in self.decisions(text):
            one, open_ = 0.0, 1.0
            for d in range(self.depth + 1):
                key = context[self.depth - d :], prefix
                if key not in self.weight:
                    one, open_ = one + open_ / 2, 0.0
                    break
                zeros, ones = self.nodes[key]
                one += open_ * self.weight[key] * (ones + 0.5) / (zeros + ones + 1)
                open_ *= 1 - self.weight[key]
            total -= math.log2(one if bit else 1 - one)
        return total


@pytest.mark.parametrize(("depth", "block"), [(1, 1 << 20), (3, 4000), (5, 2000)])
def test_context_tree(spark, depth, block):
    rows = [(i, prose(i % 7, 5 + i)) for i in range(20)] + [(50, ""), (51, None), (52, "Zz\x00é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = F.col("doc_id") % 3 != 0
    got = {r["doc_id"]: r for r in ctw.score(docs, train, depth, block, 500).collect()}
    known = [(i, t or "") for i, t in rows if i % 3]
    tree = PlainTree([t for _, t in known], depth)
    count = collections.Counter(w for _, t in known for w in tokens(t))
    count["end"] = len(known)
    total, norm = sum(count.values()), sum(count.values()) + len(count) + 1
    for i, text in rows:
        words = [*tokens(text), "end"]
        base = sum(math.log10((count[w] + 1) / norm) for w in words)
        assert got[i]["score"] == pytest.approx(-tree.bits(text or "") * math.log10(2), rel=1e-5)
        assert got[i]["base_score"] == pytest.approx(base, rel=1e-9)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (
            len(words), sum(count[w] > 0 for w in words), total)


def test_scores_of_the_query(spark):
    rows = queries.QUERIES["op1_context_tree_scoring"](spark, SF).collect()
    docs = given("documents")
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (fold(r["doc_id"], 7) == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    size = sum(r["n_bytes"] for r in held)
    assert -sum(r["score"] for r in held) / math.log10(2) / size < 2.6


@pytest.mark.parametrize(("name", "label", "n", "out", "least"), [
    ("op7_quality_classifier", "quality", 5, 0, 0.95), ("op3_toxicity", "toxic", 4, 2, 0.93)])
def test_held_out_accuracy(spark, name, label, n, out, least):
    rows = {r["doc_id"]: r for r in queries.QUERIES[name](spark, SMALL).collect()}
    labels = dict(given("labels", SMALL)[["doc_id", label]].values.tolist())
    assert all(r["held_out"] == (fold(i, n) == out) for i, r in rows.items())
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
               for r in rows.values())
    held = [i for i in labels if rows[i]["held_out"]]
    assert np.mean([rows[i]["predicted"] == labels[i] for i in held]) >= least


def test_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for operator, name, n, out in (
        (quality.classify, "quality", 5, 0), (toxicity.classify, "toxic", 4, 2)):
        hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == out
        turned = labels.withColumn(name, F.when(hidden, 1 - F.col(name)).otherwise(F.col(name)))
        one, other = (
            {r["doc_id"]: r["score"] for r in operator(docs, x).collect()} for x in (labels, turned))
        assert all(abs(one[i] - other[i]) < 1e-9 for i in one)


def test_bounded_sample(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert labelled.bounded(rows, 5000, 10_000).count() == 5000
    assert 300 < labelled.bounded(rows, 5000, 500).count() < 700


def test_isotonic():
    at, value = quality.isotonic(
        np.array([0.0, 1, 2, 3]), np.array([0.2, 0.1, 0.5, 0.9]), np.array([1.0, 3, 1, 1]))
    assert value == pytest.approx([0.125, 0.5, 0.9])
    assert at == pytest.approx([0.75, 2, 3])


def test_label_model_trusts_accurate_voters():
    votes = np.array([0b0, 0b1, 0b11, 0b1000])
    label = np.array([0, 1, -1, -1])
    model = toxicity.LabelModel(votes, label, np.array([900.0, 80, 20, 5]))
    bits = (np.array([0b0, 0b1])[:, None] >> np.arange(toxicity.N_VOTERS)) & 1
    clean, toxic = model.posterior(bits)
    assert clean < 0.1 < 0.9 < toxic


def plain_license(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        own = phrase.encode().split()
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


CASES = [
    "CC BY cc-by, CC by!", "General Public  License v3; All Rights\nReserved", "cc cc by by",
    "all rights reserved all rights reserved", "éCC BY", "CC BY", "", None, "cc_by",
]


def test_license_base_columns(spark):
    texts = [*CASES, *given("documents", SMALL)["text"].tolist()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_licenses(docs).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) \
            == plain_license(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


@pytest.mark.parametrize(("text", "labels", "score"), [
    ("mit", {"mit"}, 0.9),
    ("mit or gpl-3.0-only", {"mit", "gpl-3.0-only"}, 0.9),
    ("mit and gpl-3.0-only", {"mit", "gpl-3.0-only"}, 0.3),
    ("mit or apache-2.0 and gpl-2.0", {"mit", "apache-2.0", "gpl-2.0"}, 0.9),
    ("(mit or apache-2.0) and gpl-2.0", {"mit", "apache-2.0", "gpl-2.0"}, 0.3),
    ("gpl-2.0 with classpath-exception-2.0", {"gpl-2.0", "classpath-exception-2.0"}, 0.4),
    ("((mit))", {"mit"}, 0.9),
    ("mit and the rest of the sentence", {"mit", "the"}, 0.5),
    ("mit */ or", {"mit"}, 0.9),
])
def test_license_expressions(text, labels, score):
    terms, _ = licenses.read_expression(text)
    assert (terms.labels, terms.freedom) == (labels, pytest.approx(score))


@pytest.mark.parametrize("text", ["", ")", "and mit", "(", "(mit", "or"])
def test_unreadable_expressions(text):
    assert licenses.read_expression(text)[0] is None


@pytest.mark.parametrize("text", [
    "mit and gpl) x", "((mit) or (a and", "mit or", "(mit", "mit with x and (gpl or b) c", "()", ""])
def test_expressions_end_at_the_last_complete_place(text):
    """Against every beginning of the text: the longest that reads whole."""
    found, end = licenses.read_expression(text)
    whole = [n for n in range(len(text) + 1) if licenses.complete_tokens(text[:n], 0)[1] == n > 0]
    tokens = text[: max(whole)] if whole else None
    assert (found is None) == (not whole)
    if whole:
        assert end == max(whole)
        again, _ = licenses.read_expression(tokens)
        assert (again.labels, again.freedom) == (found.labels, found.freedom)


def test_a_long_expression_in_seconds():
    names = [f"id{n}" for n in range(100_000)]
    began = time.perf_counter()
    nested = "(" * 50_000 + "mit" + " or gpl)" * 50_000
    assert licenses.read_expression(nested)[0].labels == {"mit", "gpl"}
    found, end = licenses.read_expression(" and ".join(names))
    assert found.labels == set(names) and found.freedom == licenses.NEUTRAL
    assert end == len(" and ".join(names)) and time.perf_counter() - began < 10


def test_license_tags_in_texts(spark):
    docs = spark.createDataFrame(
        [(1, "// SPDX-License-Identifier: MIT OR GPL-2.0+\nint x;"),
         (2, "SPDX-License-Identifier: )"),
         (3, "Permission is hereby granted, free of charge, to any person")],
        "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["expressions"], r["score"])
           for r in licenses.scan_licenses(docs).collect()}
    assert got[1] == ("gpl-2.0+,mit", ["mit or gpl-2.0+"], 0.9)
    assert got[2][0] == "unreadable-tag"
    assert got[3][0] == "mit"


def test_odd_texts_score_like_no_evidence(spark):
    got = {r["doc_id"]: r for r in licenses.scan_licenses(odd_documents(spark)).collect()}
    assert (got[2]["n_words"], got[2]["labels"], got[2]["score"]) == (0, "", licenses.NEUTRAL)
