"""Mixing, chat formatting and nearest neighbours."""

import hashlib
import time

import duckdb
import numpy as np
import pytest
from conftest import SF
from odd_rows import odd_documents, prose
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tillwater.llm import chat, mixing, queries, vptree

TABLES = ("documents", "conversations", "benchmark", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_answer_as_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = contract.queries()[name](spark, SF)
    result = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    want = sorted(result.fetchall(), key=str)
    assert sorted((tuple(r[c] for c in names) for r in frame.collect()), key=str) == want and want


def test_one_query_for_each_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def mixed(spark, docs, **options):
    return mixing.mix(docs, mixing.domain_of(F.col("source")), **options)


def test_narrowing_finds_the_same_prefix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, other = (
        sorted((r["doc_id"], r["n_copies"]) for r in mixed(spark, docs, few=few).collect())
        for few in (1000, 1))
    assert one == other


def test_budgets_go_to_siblings_first(spark):
    # b/en/s2 holds too little: s3 beside it gets the rest, then language de, then domain a.
    leaves = spark.createDataFrame(
        [("a", "en", "s1", 1000), ("b", "en", "s2", 10), ("b", "en", "s3", 30),
         ("b", "de", "s4", 25), ("c", "en", "s5", 0)],
        "domain string, language string, origin string, tokens long")
    weights = {"domain": {"a": 0.5, "b": 0.5, "c": 0.0},
               "language": {"en": 0.5, "de": 0.5}, "origin": {}}

    def given(budget):
        rows = mixing.leaf_budgets(leaves, budget, 1, weights).collect()
        return {r["origin"]: r["budget"] for r in rows}

    assert given(40) == {"s1": 20, "s2": 5, "s3": 5, "s4": 10}
    assert given(60) == {"s1": 30, "s2": 7, "s3": 7, "s4": 15}
    assert given(80) == {"s1": 40, "s2": 10, "s3": 10, "s4": 20}
    assert given(120) == {"s1": 60, "s2": 10, "s3": 25, "s4": 25}
    assert given(200) == {"s1": 135, "s2": 10, "s3": 30, "s4": 25}
    assert given(5000) == {"s1": 1000, "s2": 10, "s3": 30, "s4": 25}


def test_whole_epochs_and_prefix(spark):
    rows = [(i, prose(i, 10), "en", "src0") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = [r["n_copies"] for r in mixed(spark, docs, budget_share=1.5, max_epochs=3).collect()]
    assert sorted(got) == [1] * 15 + [2] * 15
    got = [r["n_copies"] for r in mixed(spark, docs, budget_share=9.0, max_epochs=3).collect()]
    assert got == [3] * 30


def test_rows_of_one_id_are_taken_together(spark):
    for share in (0.1, 0.3, 0.6, 0.9):
        rows = mixed(spark, odd_documents(spark), budget_share=share).collect()
        assert len({r["n_copies"] for r in rows if r["doc_id"] == 6}) == 1


def test_control_strings_come_back(spark):
    texts = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "&lt;&amp;#91;", "", None,
             "a\nb\n", "<|image:1.1|>", "é𝄞&", "\\[", "<|end|>\n<|turn|>"]
    rows = [(1, n, "assistant" if n % 2 else "us\ner<", t) for n, t in enumerate(texts)]
    made = chat.format_chat(spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string"))
    first = made.select("formatted", chat.read_chat(F.col("formatted")).alias("turns")).first()
    assert [(t["role"], t["text"]) for t in first["turns"]] == [
        (r[2], r[3] or "") for r in rows]
    digest = chat.chat_digest(made).first()
    learned = "".join(r[3] or "" for r in rows if r[2] == "assistant")
    assert digest["loss_chars"] == len(learned)
    assert digest["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def test_parts(spark):
    rows = [
        (1, 1, "user", [("text", "see [this] now", None, None), ("image", None, "i.png", 4),
                        ("text", "and", None, None), ("AUDIO", None, "a.wav", 10)]),
        (1, 2, "assistant", [("text", "fine", None, None)]),
        (1, 3, "user", [("document", None, "d.pdf", None), ("video", None, "v", 9), None]),
        (1, 4, "assistant", None),
    ]
    kind = "array<struct<kind:string,text:string,ref:string,units:long>>"
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {kind}")
    r = chat.format_chat(turns, parts="parts").first()
    assert r["formatted"].startswith(
        "<|turn|>user\nsee &#91;this] now<|image:1.2|>and<|audio:1.4|><|end|>\n")
    assert [(a["turn"], a["part"], a["kind"], a["ref"], a["tokens"]) for a in r["attachments"]][
        :4] == [(1, 2, "image", "i.png", 1024), (1, 4, "audio", "a.wav", 250),
                (3, 1, "document", "d.pdf", 800), (3, 2, "other", "v", 0)]
    assert r["n_tokens"] == 3 + 1024 + 1 + 250 + 1 + 800
    assert len(r["loss_spans"]) == 2


def test_spans_are_the_learned_bodies(spark):
    """Both ways to find a span: in the whole text, and in its turn."""
    turns = spark.createDataFrame(
        [(1, 0, "user", "é𝄞 <|end|> x"), (1, 1, "assistant", "𝄞𝄞 [ok] & <b>"), (1, 2, "assistant", ""),
         (1, 3, "user", ""), (1, 4, "assistant", "last\nline")],
        "conv_id long, turn long, role string, text string")
    r = chat.format_chat(turns).select(
        "*", chat.cut_chat(F.col("formatted")).alias("pieces")).first()
    bodies = []
    for s in r["loss_spans"]:
        whole = r["formatted"][s["start"] - 1 : s["start"] - 1 + s["length"]]
        assert r["pieces"][s["turn"] - 1][s["place"] - 1 :] == whole
        assert len(whole) == s["length"]
        bodies.append(whole)
    assert [s["turn"] for s in r["loss_spans"]] == [2, 3, 5] and bodies[1:] == ["", "last\nline"]


def test_a_long_conversation_in_seconds(spark):
    n = 16_000
    turns = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.repeat(F.lit("ab<é "), 56).alias("text"))
    began = time.perf_counter()
    r = chat.chat_digest(chat.format_chat(turns)).first()
    assert time.perf_counter() - began < 40
    assert (r["n_turns"], r["loss_chars"]) == (n, n // 2 * 280)
    assert r["loss_sha256"] == hashlib.sha256(("ab<é " * 56 * (n // 2)).encode()).hexdigest()


def test_odd_turns(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x"), (2, 1, "b", "y"), (2, 1, "a", "y"),
            (2, 1, "a", "x"), (2, 1, "a", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    read = chat.format_chat(turns.withColumn("piece", F.lit(1)).withColumn("at", F.lit(2)))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in read.select(
        "conv_id", chat.read_chat(F.col("formatted")).alias("turns")).collect()}
    assert got == {None: [("", ""), ("user", "x")],
                   2: [("a", "x"), ("a", "x"), ("a", "y"), ("b", "y")]}
    assert chat.chat_digest(chat.format_chat(turns.limit(0))).collect() == []


def plain_nearest(rows, k):
    usable = {i: np.array(v, float) for i, v in rows
              if v is not None and None not in v and np.isfinite(np.array(v, float)).all()
              and any(v)}
    out = {}
    for q, x in usable.items():
        if q % 20 == 0:
            score = sorted((-float(x @ y), i) for i, y in usable.items() if i != q)[:k]
            out[q] = [(i, -s) for s, i in score]
    return out


def vectors():
    random = np.random.default_rng(3)
    centres = random.normal(size=(6, 8))
    rows = [(n, (centres[n % 6] * random.uniform(0.5, 2) + random.normal(size=8) * 0.2).tolist())
            for n in range(900)]
    rows += [(n, rows[5][1]) for n in range(1000, 1080)]  # one very common vector
    rows += [(2000, None), (2001, [0.0] * 8), (2020, [float("nan")] * 8), (2003, [None] * 8),
             (2040, [float("inf")] * 8)]
    return rows


@pytest.mark.parametrize(("shard", "asked", "leaf"), [(8192, 16384, 256), (150, 20, 30)])
def test_exact_search(spark, monkeypatch, shard, asked, leaf):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in vptree.nearest(
            frame, F.col("id") % 20 == 0, 20, 1.0, shard_rows=shard, query_rows=asked).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = plain_nearest(rows, 20)
    assert set(got) == set(want)
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [f[1] for f in found] == [i for i, _ in want[q]], q
        assert [f[2] for f in found] == pytest.approx([s for _, s in want[q]], rel=1e-12)


def test_recall_of_the_query(spark):
    frame = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    want = plain_nearest(frame, 20)
    got = {}
    for r in queries.QUERIES["op8_nearest_neighbours"](spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = [len(got[q] & {i for i, _ in best}) / len(best) for q, best in want.items()]
    assert set(got) == set(want) and np.mean(hits) >= 0.9


def test_few_and_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 1.0]), (20, [0.0, 1.0])], kind)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in vptree.nearest(
        few, F.col("id") % 20 == 0).collect())
    assert got == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert vptree.nearest(few.limit(0), F.col("id") % 20 == 0).collect() == []


def test_one_long_vector_hides_no_neighbour(spark):
    random = np.random.default_rng(8)
    x = random.normal(size=(3000, 16))
    x *= random.uniform(0.5, 2, (3000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    x[7] *= 20
    x[11] *= 100
    rows = [(n, v.tolist()) for n, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = plain_nearest(rows, 20), {}
    for r in vptree.nearest(frame, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert {q: [i for _, i in sorted(f)] for q, f in got.items()} == {
        q: [i for i, _ in best] for q, best in want.items()}


def test_ties_of_unlike_vectors_go_to_the_smaller_id():
    random = np.random.default_rng(9)
    x = random.choice([-1.0, 1.0], size=(2000, 16))
    ids, own = random.permutation(2000), np.arange(0, 2000, 20)
    who, found, score = vptree.search_shard(ids, x, ids[own], x[own], 16.0, 20, vptree.FACTOR)
    for place in own:
        every = x @ x[place]
        want = sorted((-s, i) for s, i in zip(every, ids, strict=True) if i != ids[place])[:20]
        here = who == ids[place]
        assert list(zip(-score[here], found[here], strict=True)) == want
