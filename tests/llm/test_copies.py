"""SimHash, long repeats, decontamination and their helpers against brute force."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
import xxhash
from conftest import SF
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from odd_rows import ODD, odd_documents, prose
from pyspark.sql import functions as F

from tillwater.llm import components, decontamination, queries, repeats, simhash
from tillwater.llm.runindex import RunIndex


def documents(folder=SF):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(marks, radius):
    """Smallest id reachable over links of near fingerprints."""
    least = {i: i for i in marks}
    changed = True
    while changed:
        changed = False
        for i in marks:
            for j in marks:
                if (marks[i] ^ marks[j]).bit_count() <= radius and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_fingerprints(spark):
    rows = documents() + [(i, t) for i, t, *_ in ODD if i is not None and i not in (6, 7)]
    docs = spark.createDataFrame(
        [(n, t) for n, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(docs).collect()}
    assert all(got[n] % (1 << 64) == plain_fingerprint(t) for n, (_, t) in enumerate(rows))


def test_shingle_hash_is_sparks(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a bé c"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("a bé c".encode(), seed=42)


@pytest.mark.parametrize(("most", "blocks"), [(20_000, None), (3, 4), (1, 5), (20_000, 6)])
def test_near_fingerprints_meet(spark, most, blocks):
    random = np.random.default_rng(5)
    centres = random.integers(0, 1 << 63, 12, dtype=np.uint64)
    marks = {}
    for n in range(150):
        flips = random.choice(64, random.integers(0, 5), replace=False)
        marks[n] = int(centres[n % 12]) ^ sum(1 << int(b) for b in flips)
    first = {m: n for n, m in reversed(marks.items())}
    classes = spark.createDataFrame(
        [(m - (1 << 64) if m >> 63 else m, n) for m, n in first.items()], "fp long, rep long")
    units = simhash.comparison_units(classes, 3, most, blocks)
    joined = components.components(simhash.linked(units, 3))
    got = {r["node"]: r["component"] for r in joined.collect()}
    want = plain_groups(marks, 3)
    assert all(got.get(first[m], first[m]) == want[n] for n, m in marks.items())


def test_components_of_odd_rows(spark):
    got = {}
    for r in simhash.near_duplicates(odd_documents(spark)).collect():
        got.setdefault(r["doc_id"], r)
    assert got[2]["fingerprint"] == "0" * 16 == got[4]["fingerprint"]
    assert [got[i]["component_id"] for i in (1, 5, 6)] == [1, 1, 1]
    assert [got[i]["component_id"] for i in (2, 3, 4)] == [2, 2, 2]
    assert got[None]["component_id"] is None


def test_components(spark):
    path = [(i, i + 1) for i in range(40)]
    edges = [*path, (100, 101), (101, 100), (7, 7), (200, 100), (300, 200)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 200, 300)}}
    assert components.components(frame.where("a = 7 AND b = 7")).collect() == []


def plain_repeats(rows, length):
    """(kept, removed bytes, spans) of each (id, text), oldest first."""
    seen, out = {}, []
    for n, (i, text) in enumerate(rows):
        raw = (text or "").encode()
        keep = np.ones(len(raw), bool)
        for p in range(len(raw) - length + 1):
            first = seen.setdefault(raw[p : p + length], (i, p))
            if first < (i, p):
                keep[p : p + length] = False
        kept = np.frombuffer(raw, np.uint8)[keep].tobytes()
        starts = np.diff((~keep).astype(int), prepend=0) == 1
        out.append((n, kept, int((~keep).sum()), int(starts.sum())))
    return out


def check_repeats(spark, rows, length=100, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = repeats.keyed(docs).select(
        "doc_id", "key", "rid", F.coalesce("text", F.lit("")).alias("text"))
    spans = repeats.removed_spans(base, length, **options)
    got = {}
    for r in repeats.with_spans(base, spans).collect():
        kept = repeats.spared(r["text"].encode(), r["starts"], r["ends"], False)
        got.setdefault((r["doc_id"], r["text"]), []).append(
            (kept, sum(r["ends"]) - sum(r["starts"]), len(r["starts"])))
    for n, kept, removed, spans in plain_repeats(rows, length):
        assert (kept, removed, spans) in got[rows[n][0], rows[n][1] or ""], rows[n]


def mosaic(seed, n):
    """Texts put together from a few passages, whole and in part, with small changes."""
    random = np.random.default_rng(seed)
    passages = [prose(s, 60) for s in range(4)] + ["ab" * 200, "x" * 250]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(random.integers(0, 4)):
            passage = passages[random.integers(len(passages))]
            a, b = sorted(random.integers(0, len(passage), 2))
            text += passage[a:b] if random.random() < 0.6 else passage
            if random.random() < 0.4:
                text += prose(int(random.integers(1000)), 10)
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("options", [{}, {"most_segments": 1}, {"most_rows": 3}])
def test_repeats(spark, options):
    check_repeats(spark, mosaic(1, 60) + [(100, None), (101, "")], **options)


def test_repeats_of_other_lengths(spark):
    check_repeats(spark, mosaic(2, 30), length=60)


def test_repeated_ids_are_judged_one_by_one(spark):
    text = prose(3, 50)
    check_repeats(spark, [(1, text), (1, text), (1, "zz" + text), (2, text)])


def test_long_texts_in_parts(spark, monkeypatch):
    line = np.frombuffer((prose(4, 4000) * 2).encode(), np.uint8)
    whole = repeats.segments_in(line, np.array([0, len(line)]), 100)
    monkeypatch.setattr(repeats, "PIECE", 5000)
    starts = []
    for _, shift, part, offsets in repeats.text_pieces(line, np.array([0, len(line)]), 100):
        found = repeats.segments_in(part, offsets, 100)
        for p, n in zip(found["p"], found["n"], strict=True):
            starts.extend(range(shift + p, shift + p + n))
    covered = [p + k for p, n in zip(whole["p"], whole["n"], strict=True) for k in range(n)]
    assert starts == covered == list(range(len(line) - 99))


def test_repeats_of_the_tables(spark):
    rows = sorted(documents())
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_suffix_dedup"](spark, SF).collect()}
    for n, kept, removed, spans in plain_repeats(rows, 100):
        r = got[rows[n][0]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(rows[n][1].encode()), removed, spans, hashlib.sha256(kept).hexdigest())


@settings(max_examples=150, deadline=None)
@drawn(st.lists(st.text("abé", max_size=60).map(str.encode), min_size=1, max_size=6),
       st.integers(7, 40))
def test_run_index(segments, depth):
    line = np.frombuffer(b"".join(segments), np.uint8)
    offsets = np.cumsum([0, *map(len, segments)])
    found = RunIndex(line, offsets, depth).earliest()
    seen = {}
    for s, segment in enumerate(segments):
        for p in range(len(segment)):
            place = offsets[s] + s + p
            if p + depth <= len(segment):
                assert found[place] == seen.setdefault(segment[p : p + depth], place)
            else:
                assert found[place] == place


def test_whole_characters_stay():
    text = "aéé𝄞b".encode()
    for a in range(len(text)):
        for b in range(a, len(text) + 1):
            repeats.spared(text, [a], [b], True).decode()


def plain_score(words, item, diagonal):
    best = now = 0
    for j, w in enumerate(item):
        if 0 <= j + diagonal < len(words):
            now = max(0, now + (1 if words[j + diagonal] == w else -decontamination.SUBSTITUTION))
            best = max(best, now)
    return best


def plain_contaminated(docs, items):
    def cut(text):
        return re.split(decontamination.PARTS_WORDS, (text or "").lower())

    found = {}
    for i, text in docs:
        words = cut(text)
        for k, passage in items:
            item = [w for w in cut(passage) if w]
            for mask in decontamination.MASKS:
                seeds = {}
                for p in range(len(item) - mask[-1]):
                    seeds.setdefault(tuple(item[p + o] for o in mask), []).append(p)
                for q in range(len(words) - mask[-1]):
                    for p in seeds.get(tuple(words[q + o] for o in mask), ()):
                        score = plain_score(words, item, q - p)
                        need = max(decontamination.LEAST_SCORE, min(
                            decontamination.FULL_SCORE,
                            -(-len(item) * 6 // 10)))
                        if score >= need:
                            found[i, k] = max(score, found.get((i, k), 0))
    return found


@pytest.mark.parametrize("most", [decontamination.MOST_BROADCAST, 0])
def test_contaminated(spark, most):
    random = np.random.default_rng(7)
    items = [(k, prose(k + 500, n)) for k, n in enumerate((40, 25, 14, 9, 5, 200))]
    docs = []
    for i in range(40):
        words = prose(i, int(random.integers(0, 400))).split()
        if i % 3 == 0:
            item = items[i // 3 % 6][1].split()
            for _ in range(i % 4):
                item[random.integers(len(item))] = "changed"
            at = random.integers(0, len(words) + 1)
            words[at:at] = item if i % 2 else item[: len(item) // 2 + 1]
        docs.append((i, " ".join(words)))
    docs.append((99, None))
    got = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), most)
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in got.collect()}
    assert found == plain_contaminated(docs, items) and found
