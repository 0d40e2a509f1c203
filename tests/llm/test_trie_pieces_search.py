"""Prefix trie, SentencePiece and lexical search against brute force and the library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from odd_rows import ODD, no_documents, odd_documents
from pyspark.sql import functions as F

from tillwater.llm import lexical, prefixtrie, queries, sentencepieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TURNS = "conv_id long, turn long, role string, text string"


# --- op11: prefix trie ------------------------------------------------------


def plain_trie(convs):
    """{conv_id: [(role, text), ...]} to rows, straight from the definition."""
    members = defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = Counter(node[:-1] for node in members if node)
    rows = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        rows.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
            children[node], sum(not children[x] for x in below),
            sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def random_convs(seed, n, most):
    """Conversations that share beginnings; a third of them are the same."""
    r = random.Random(seed)
    turns = [("user", "a"), ("user", "ab"), ("assistant", "é"), ("", ""), ("u", "sera")]
    same = [turns[0]] * most
    return {
        c: same if r.random() < 0.34 else [r.choice(turns) for _ in range(r.randint(0, most))]
        for c in r.sample(range(-5, 3 * n), n)}


def as_rows(spark, convs):
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, TURNS)


def listed(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize(("n", "longest", "most"), [(60, 5, 4), (60, 5, 500_000), (40, 30, 20)])
def test_trie(spark, n, longest, most):
    convs = {c: t for c, t in random_convs(n, n, longest).items() if t}
    found = prefixtrie.prefix_trie(
        prefixtrie.conversations(as_rows(spark, convs)), most)
    assert listed(found) == plain_trie(convs)


def test_trie_without_turns_and_of_one_conversation(spark):
    for convs in ({7: []}, {7: [], 8: [], 3: [("u", "x")]}, {5: [("u", "x")] * 400}):
        frame = spark.createDataFrame(
            [(c, [(hashlib.sha256(repr(t).encode()).digest()[:16], len(t[1])) for t in turns])
             for c, turns in convs.items()],
            "conv_id long, turns array<struct<digest:binary,size:long>>")
        assert listed(prefixtrie.prefix_trie(frame, 50)) == plain_trie(convs)
    assert prefixtrie.prefix_trie(frame.limit(0)).collect() == []


def test_trie_of_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, None, "user", "first"), (1, 2, None, None), (1, 2, None, None),
        (2, None, "user", "first"), (2, 0, "user", "a"), (3, 5, "", ""), (None, 0, "user", "a"),
        (4, 1, "usera", ""), (5, 1, "user", "a")]
    plain = {
        1: [("user", "first"), ("user", "a"), ("", ""), ("", "")],
        2: [("user", "first"), ("user", "a")], 3: [("", "")], 4: [("usera", "")],
        5: [("user", "a")]}
    frame = spark.createDataFrame(rows, TURNS)
    for name in ("node", "parent", "digest", "t", "turns", "key", "class", "block", "side"):
        frame = frame.withColumn(name, F.lit("clash"))
    convs = prefixtrie.conversations(frame)
    assert listed(prefixtrie.prefix_trie(convs, 3)) == plain_trie(plain)
    assert prefixtrie.conversations(frame.limit(0)).collect() == []


def test_turns_of_one_number_have_an_order(spark):
    rows = [(1, 0, "user", t) for t in "abc"]
    both = [prefixtrie.conversations(spark.createDataFrame(r, TURNS)).collect()
            for r in (rows, rows[::-1])]
    assert both[0] == both[1]


def test_rebuilt_conversations(spark):
    """Short, absent and own bases, against the query's definition."""
    convs = {c: [("u", f"{c // 5}{i}") for i in range(c % 11)] for c in range(3, 60) if c % 7}
    convs = {c: t for c, t in convs.items() if t}
    want = {}
    for c, own in convs.items():
        head = zlib.crc32(str(c).encode()) % 9
        want[c] = convs.get(c - c % 5, [])[:head] + own[head:]
    conv = F.col("conv_id")
    built = prefixtrie.rebuilt(
        prefixtrie.conversations(as_rows(spark, convs)), conv - conv % 5,
        (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int"), 8)
    assert any(not t for t in want.values())
    assert listed(prefixtrie.prefix_trie(built, 30)) == plain_trie(want)


@settings(max_examples=60, deadline=None)
@drawn(st.lists(st.lists(st.integers(0, 2), max_size=5), min_size=1, max_size=25), st.data())
def test_extents_are_the_members(sequences, data):
    keys = sorted({b"".join(bytes([v]) * 16 for v in s) for s in sequences})
    row = data.draw(st.integers(0, len(keys) - 1))
    depth = data.draw(st.integers(0, len(keys[row]) // 16))
    left, right = prefixtrie.extents(
        prefixtrie.Minima(prefixtrie.shared_turns(keys)), np.array([row]), np.array([depth]),
        len(keys))
    start = keys[row][: 16 * depth]
    members = [i for i, k in enumerate(keys) if k.startswith(start)]
    assert (left[0], right[0]) == (members[0], members[-1])


@pytest.mark.parametrize("at_once", [2, 100_000])
def test_ids_of_a_large_class(spark, at_once):
    ids = random.Random(1).sample(range(100_000), 3000)
    frame = spark.createDataFrame(
        [(bytearray(b"x" if i % 3 else bytes([i % 7])), i) for i in ids],
        "class binary, conv_id long")
    want = defaultdict(list)
    for i in sorted(ids):
        want[b"x" if i % 3 else bytes([i % 7])].append(str(i))
    got = {bytes(r["class"]): r["ends_sha256"]
           for r in prefixtrie.endings(frame.repartition(7), at_once).collect()}
    assert got == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}


# --- op12: SentencePiece ----------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def encoded(table, texts, size):
    ids, ends, raw, raw_ends = sentencepieces.encode_texts(table, texts, size)
    return ([x.tolist() for x in np.split(ids, ends[:-1])],
            [x.tobytes().decode() for x in np.split(raw, raw_ends[:-1])])


SPACED = st.text(st.sampled_from("a b▁é\n\t_𝄞\x00the　<s>"), max_size=14)


@settings(max_examples=300, deadline=None)
@drawn(st.lists(SPACED, min_size=1, max_size=5), st.sampled_from([1, 2, 5, 1 << 20]))
def test_ids_are_the_librarys(library, texts, size):
    ids, decoded = encoded(sentencepieces.ChunkTable(MODEL, 20), texts, size)
    assert ids == library.encode(texts)
    assert decoded == library.decode(ids)


def test_documents_and_odd_rows(spark, library):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text").collect()] + [(i, t) for i, t, *_ in ODD]
    docs = spark.createDataFrame(given, "doc_id long, text string").withColumn(
        "ids", F.lit("clash")).withColumn("decoded", F.lit("clash"))
    want = []
    for doc, text in given:
        ids = library.encode(text or "") + [library.eos_id()]
        want.append((doc, ids, library.decode(ids)))
    for most, size in ((400_000, 1 << 20), (100, 300)):
        got = sentencepieces.encode(docs, MODEL, most=most, size=size).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sentencepieces.encode(no_documents(spark), MODEL).collect() == []
    bare = sentencepieces.encode(odd_documents(spark), MODEL, end=False).where("doc_id = 2").first()
    assert (bare["ids"], bare["decoded"]) == ([], "")


def test_query_digests(spark, library):
    got = {r["doc_id"]: r for r in queries.op12_sentencepiece(spark, SF).collect()}
    for doc, text in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall():
        ids = library.encode(text or "") + [2]
        assert got[doc]["n_tokens"] == len(ids)
        assert got[doc]["ids_sha256"] == hashlib.sha256(
            " ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc]["decoded_sha256"] == hashlib.sha256(
            library.decode(ids).encode()).hexdigest()


def test_long_text(library):
    text = "wörd  and\n" * 600_000
    ids, decoded = encoded(sentencepieces.ChunkTable(MODEL), [text, "x"], 1 << 20)
    assert decoded == [text, "x"] and ids[1] == library.encode("x")
    assert ids[0] == library.encode(text)


# --- op13: lexical search ---------------------------------------------------

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in t)
            for t in LETTERS.findall(text or "")]


def plain_search(docs, items, top=20):
    """Rows (item_id, rank, doc_id, score) from the definition."""
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = defaultdict(Counter)
    for i, t in items:
        if i is not None:
            asked[i] += Counter(plain_terms(t))
    rows = []
    for item, terms in asked.items():
        found = []
        for doc, counts, n in held:
            m = 100 - 25 + 25 * n * n_docs // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
                for t, times in terms.items() if t in counts)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        rows += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:top], 1)]
    return sorted(rows, key=str)


def searched(spark, docs, items, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("n", "terms", "counts", "score", "item_id"):
        frame = frame.withColumn(name, F.lit("clash"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn(
        "term", F.lit("clash")).withColumn("times", F.lit("clash"))
    return listed(lexical.search(frame, asked, **options))


@pytest.mark.parametrize("options", [{}, {"most": 300, "size": 40}, {"top": 3}])
def test_search(spark, options):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    docs += [(i, t) for i, t, *_ in ODD]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    items += [(900, None), (901, ""), (902, "one One  two"), (None, "one"), (items[0])]
    got = searched(spark, docs, items, **options)
    assert got == plain_search(docs, items, options.get("top", 20))


def test_ties_copies_and_boundaries(spark):
    docs = [(n, "Äpfel und birnen, UND") for n in range(40, 0, -1)] + [
        (None, "Äpfel und birnen, UND"), (77, "äpfel"), (78, "undundund bund"), (78, "und"),
        (78, "und"), (79, None), (80, "... \n")]
    items = [(1, "und und Äpfel"), (2, "bund"), (3, "nowhere"), (2, "BIRNEN")]
    assert searched(spark, docs, items) == plain_search(docs, items)


def test_nothing_to_search(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a"), (2, None)], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []


def test_long_document(spark):
    docs = [(1, "alpha beta " * 500_000), (2, "beta"), (3, "gamma delta")]
    items = [(1, "alpha"), (2, "beta beta")]
    assert searched(spark, docs, items) == plain_search(docs, items)


def test_odd_documents_bear_search(spark):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    plain = listed(lexical.search(odd_documents(spark), items))
    assert plain and plain == listed(lexical.search(odd_documents(spark, clashing=True), items))
