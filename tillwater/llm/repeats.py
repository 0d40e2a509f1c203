"""Removal of long repeated byte strings, with run-length indexes.

A byte goes if a string of `length` bytes that covers it also starts earlier, in a
document with a smaller id or earlier in the same document. All strings are judged on the
input and none crosses documents.

1. Every string of `length` bytes has an anchor, the place of the smallest hash among its
   ANCHOR-byte pieces, so equal strings have equal anchors at equal places. Neighbouring
   strings with one anchor form a segment. Scan tasks keep the first of equal segments.
2. Segments meet by anchor, over all documents. Equal segments leave the first; anchors
   with one kind of segment need no more.
3. Segments that share an anchor but differ meet again with their text, and groups of them
   of about INDEX_BYTES go into a run-length index (run-compressed Burrows-Wheeler
   transform with sampled ends), through which each segment is streamed; places whose
   next `length` bytes occur earlier are marked. An anchor with more than MOST_SEGMENTS
   kinds isn't gathered in one task: its strings meet by their own hashes instead, which
   marks the same places.
4. Marks are merged to spans per document.

Defined cases: a null text is empty; texts shorter than `length` keep everything; a null
doc_id counts as smaller than all others; rows that share a doc_id are judged one by one,
and strings that start at the same place of them are equally early, so neither removes
the other; other columns are never read by `removed_spans`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut, groups, mapped, raw_bytes
from tillwater.llm.runindex import RunIndex

LENGTH = 100
ANCHOR = 16
MOST_SEGMENTS = 4096
#: Rows of one anchor that a task holds at once.
MOST_ROWS = 2_000_000
VERY_MANY = 1 << 40
INDEX_BYTES = 1 << 19
PIECE = 4 << 20
NULL_ID = -(1 << 63)
ROWS = 1_000_000


def windows_of(held: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start in `held` (shorter than 2^24): its anchor's place; and all hashes."""
    padded = np.concatenate([held, np.zeros(16, np.uint8)])
    words = np.ndarray((len(held),), "<u8", padded.tobytes(), strides=(1,))
    span = length - ANCHOR + 1
    n = len(held) - length + 1
    with np.errstate(over="ignore"):
        hashed = words[: len(held) - 8] * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= words[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
    # The hash above, the place below: minima are leftmost smallest hashes.
    low = np.uint64((1 << 24) - 1)
    least = (hashed & ~low) | np.arange(len(hashed), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: -(span - width)], least[span - width :])
    return (least[:n] & low).astype(np.int64), hashed


def segments_in(held: np.ndarray, starts: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Segments of texts laid end to end: text number, anchor and segment hash, first start,
    number of strings, place of the anchor within the segment."""
    if len(held) < length:
        return {k: np.zeros(0, np.int64) for k in ("text", "h", "seg", "p", "n", "o")}
    anchor, hashed = windows_of(held, length)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(anchor)]
    at = np.flatnonzero(np.arange(len(anchor)) + length <= starts[1:][text])
    anchor, text = anchor[at], text[at]
    if not len(at):
        return {k: np.zeros(0, np.int64) for k in ("text", "h", "seg", "p", "n", "o")}
    first = np.flatnonzero(
        np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    p = at[first]
    n = at[np.append(first[1:], len(at)) - 1] - p + 1
    anchor, text = anchor[first], text[first]
    raw = held.tobytes()
    ends = (p + n + length - 1).tolist()
    seg = np.fromiter(
        (xxhash.xxh3_64_intdigest(raw[a:b], o) for a, b, o in zip(
            p.tolist(), ends, (anchor - p).tolist(), strict=True)), np.uint64, len(p))
    return {
        "text": text, "h": hashed[anchor].view(np.int64), "seg": seg.view(np.int64), "p": p,
        "n": n, "o": anchor - p}


def text_pieces(
    held: np.ndarray, starts: np.ndarray, length: int,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, shift, bytes, offsets) of about PIECE bytes; a longer text comes in
    overlapping parts, which together hold each of its strings once."""
    i = 0
    while i < len(starts) - 1:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE, side="right")) - 1)
        size = int(starts[j] - starts[i])
        if j > i + 1 or size <= 2 * PIECE:
            yield i, 0, held[starts[i] : starts[j]], starts[i : j + 1] - starts[i]
        else:
            for shift in range(0, max(1, size - length + 1), PIECE):
                part = held[starts[i] + shift : min(starts[i] + shift + PIECE + length - 1,
                                                    starts[j])]
                yield i, shift, part, np.array([0, len(part)])
        i = j


def columns(table: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(table[n]) for n in names], names=names)


KEY = ["h", "seg", "key", "rid", "p", "n", "o"]


def before(keys: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i come strictly before rows j by the (key, p) columns."""
    (k, p) = keys
    return (k[i] < k[j]) | ((k[i] == k[j]) & (p[i] < p[j]))


def collapsed(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers in order of (h, seg, key, p), and whether each is later than the first
    of its segment."""
    order = np.lexsort((rows["p"], rows["key"], rows["seg"], rows["h"]))
    h, seg = rows["h"][order], rows["seg"][order]
    fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (seg[1:] != seg[:-1])])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return order, before([rows["key"], rows["p"]], order[first], order)


def merged(rows: dict[str, np.ndarray], length: int) -> dict[str, np.ndarray]:
    """Segments as spans (key, rid, p, e), neighbours and overlaps joined."""
    if not len(rows["p"]):
        return {k: np.zeros(0, np.int64) for k in ("key", "rid", "p", "e")}
    order = np.lexsort((rows["p"], rows["rid"], rows["key"]))
    key, rid, p = (rows[k][order] for k in ("key", "rid", "p"))
    end = p + rows["n"][order] + length - 1
    own = np.concatenate([[True], (key[1:] != key[:-1]) | (rid[1:] != rid[:-1])])
    group = np.cumsum(own) - 1
    # Ends only grow within a text if compared with all before: shift each text apart.
    far = np.maximum.accumulate(end + group * (1 << 40)) - group * (1 << 40)
    fresh = own | np.concatenate([[True], p[1:] > far[:-1]])
    at = np.flatnonzero(fresh)
    return {"key": key[at], "rid": rid[at], "p": p[at],
            "e": far[np.append(at[1:], len(p)) - 1]}


def scan(length: int):
    """Segments of the documents of a task, equal ones once, and spans of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[dict[str, np.ndarray]] = []

        def answer() -> Iterator[pa.RecordBatch]:
            rows = {k: np.concatenate([x[k] for x in parts]) for k in KEY}
            order, later = collapsed(rows)
            spans = merged({k: v[order[later]] for k, v in rows.items()}, length)
            kept = {k: v[order[~later]] for k, v in rows.items()}
            for start in range(0, len(kept["h"]), 50_000):
                some = {k: v[start : start + 50_000] for k, v in kept.items()}
                yield columns(some | {"e": np.full(len(some["h"]), -1)}, [*KEY, "e"])
            none = np.zeros(len(spans["key"]), np.int64)
            if len(none):
                yield columns(
                    spans | {"h": none, "seg": none, "n": none, "o": none}, [*KEY, "e"])
            parts.clear()

        n = 0
        for batch in batches:
            key, rid = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            held, starts = raw_bytes(batch.column(2))
            for first, shift, part, offsets in text_pieces(held, starts, length):
                found = segments_in(part, offsets, length)
                text = found["text"]
                found["p"] = found["p"] - offsets[text] + shift
                found |= {"key": key[first + text], "rid": rid[first + text]}
                parts.append(found)
                n += len(text)
                if n >= ROWS:
                    yield from answer()
                    n = 0
        if n:
            yield from answer()

    return run


def anchor_rows(
    batches: Iterator[pa.RecordBatch], least: int, most: int,
) -> Iterator[tuple[pa.Table, int | None]]:
    """Rows of whole anchors, `least` at a time; and the anchor, if any, that was split
    between kinds of segment because it alone has more than `most` rows. Rows that are
    spans already come by themselves."""
    held: list[pa.RecordBatch] = []
    split: int | None = None
    for batch in batches:
        is_span = pc.greater_equal(batch.column(7), 0)
        if pc.any(is_span).as_py():
            yield pa.Table.from_batches([batch.filter(is_span)]), None
            batch = batch.filter(pc.invert(is_span))
        if not batch.num_rows:
            continue
        held.append(batch)
        n = sum(b.num_rows for b in held)
        if n < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        h = table.column("h").to_numpy()
        ends = np.flatnonzero(h[1:] != h[:-1]) + 1
        if not len(ends) and n >= most:
            seg = table.column("seg").to_numpy()
            ends = np.flatnonzero(seg[1:] != seg[:-1]) + 1
            split = int(h[0]) if len(ends) else split
        if len(ends):
            yield table.slice(0, int(ends[-1])), split
            split = split if split == h[-1] else None
            table = table.slice(int(ends[-1])).combine_chunks()
        held = table.to_batches()
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks(), split


def sort_out(length: int, most: int):
    """From segments in order of anchor: spans of later equal ones (e >= 0), and the first
    ones of anchors with several kinds (n_kinds > 1; very many, if the anchor was split)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, split in anchor_rows(batches, min(most, 200_000), most):
            if table.column("e")[0].as_py() >= 0:
                own = {k: table.column(k).to_numpy() for k in ("key", "rid", "p", "e")}
                none = np.zeros(table.num_rows, np.int64)
                yield columns(own | {"h": none, "n": none, "o": none, "kinds": none}, OUT)
                continue
            rows = {k: table.column(k).to_numpy() for k in KEY}
            order, later = collapsed(rows)
            # Of rows that tie for first, one stands for the segment.
            h, seg = rows["h"][order], rows["seg"][order]
            fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (seg[1:] != seg[:-1])])
            spans = merged({k: v[order[later]] for k, v in rows.items()}, length)
            owner = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
            kinds = np.bincount(owner, weights=fresh).astype(np.int64)[owner]
            if split is not None:
                kinds[h == split] = VERY_MANY
            # Ties stay too: their own strings may be later than those of another kind.
            open_ = order[~later & (kinds > 1)]
            yield columns(
                {k: rows[k][open_] for k in ("h", "key", "rid", "p", "n", "o")}
                | {"e": np.full(len(open_), -1), "kinds": kinds[~later & (kinds > 1)]}, OUT)
            none = np.zeros(len(spans["key"]), np.int64)
            yield columns(
                spans | {"h": none, "n": none, "o": none, "kinds": none}, OUT)

    return run


OUT = ["h", "key", "rid", "p", "n", "o", "e", "kinds"]


def cut_out(length: int):
    """The bytes of the segments listed beside each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, rid, texts, lists = batch.columns
            for i in range(batch.num_rows):
                raw = texts[i].as_buffer().to_pybytes()
                wanted = lists[i].values
                p = wanted.field("p").to_numpy()
                n = wanted.field("n").to_numpy()
                found = [raw[a:b] for a, b in zip(p, p + n + length - 1, strict=True)]
                for start in range(0, len(found), 10_000):
                    some = slice(start, start + 10_000)
                    m = len(found[some])
                    yield pa.RecordBatch.from_arrays(
                        [wanted.field("h")[some], pa.array([key[i].as_py()] * m, pa.int64()),
                         pa.array([rid[i].as_py()] * m, pa.int64()), wanted.field("p")[some],
                         wanted.field("n")[some], wanted.field("o")[some],
                         wanted.field("kinds")[some], pa.array(found[some], pa.binary())],
                        names=["h", "key", "rid", "p", "n", "o", "kinds", "bytes"])

    return run


def shared_sides(
    h: np.ndarray, line: np.ndarray, offsets: np.ndarray, o: np.ndarray, length: int,
) -> np.ndarray:
    """Segments that share an anchor's longer side with another one: only they can share a
    whole string, which reaches `side` bytes to the left or to the right of the anchor."""
    side = -(-(length - ANCHOR) // 2)
    padded = np.concatenate([line, np.zeros(8, np.uint8)])
    words = np.ndarray((len(line) + 1,), "<u8", padded.tobytes(), strides=(1,))
    keep = np.zeros(len(h), bool)
    for start, fits in (
        (o - side, o >= side), (o, offsets[:-1] + o + ANCHOR + side <= offsets[1:])):
        own = np.flatnonzero(fits)
        at = offsets[:-1][own] + start[own]
        with np.errstate(over="ignore"):
            code = h[own].view(np.uint64).copy()
            for step in [*range(0, side + ANCHOR - 8, 8), side + ANCHOR - 8]:
                code = (code ^ words[at + step]) * np.uint64(0x9E3779B97F4A7C15)
                code ^= code >> np.uint64(31)
        _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
        keep[own[count[inverse] > 1]] = True
    return keep


def indexed(length: int):
    """Spans of later strings among segments in order of anchor, by run-length indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def size(batch: pa.RecordBatch) -> int:
            return int(batch.num_rows * length + batch.column(6).nbytes // 2)

        for table in groups(batches, 2 * INDEX_BYTES, size):
            h, key, rid, p, n, o = (table.column(i).to_numpy() for i in range(6))
            line, offsets = raw_bytes(table.column(6).combine_chunks())
            keep = np.flatnonzero(shared_sides(h, line, offsets, o, length))
            if not len(keep):
                continue
            # Oldest first, so that the first place in the line is the oldest.
            order = keep[np.lexsort((p[keep], key[keep]))]
            sizes = np.diff(offsets)[order]
            own = np.concatenate([[0], np.cumsum(sizes)])
            picked = line[np.repeat(offsets[order] - own[:-1], sizes) + np.arange(own[-1])]
            first = RunIndex(picked, own, length).earliest()
            key, rid, p, n = key[order], rid[order], p[order], n[order]
            # Places of strings in the marked line, their segment, and the oldest equal one's.
            base = own[:-1] + np.arange(len(order))
            segment = np.repeat(np.arange(len(order)), n)
            step = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
            place = base[segment] + step
            old = first[place]
            old_segment = np.searchsorted(base, old, side="right") - 1
            old_start = p[old_segment] + old - base[old_segment]
            start = p[segment] + step
            later = (key[old_segment] < key[segment]) | (
                (key[old_segment] == key[segment]) & (old_start < start))
            hit = np.flatnonzero(later)
            spans = merged(
                {"key": key[segment[hit]], "rid": rid[segment[hit]], "p": start[hit],
                 "n": np.ones(len(hit), np.int64)}, length)
            yield columns(spans, ["key", "rid", "p", "e"])

    return run


def strings_of(length: int):
    """Each string of a segment, as a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, key, rid, p, n, o = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            for i, raw in enumerate(batch.column(6)):
                held = raw.as_buffer().to_pybytes()
                code = [xxhash.xxh3_64_intdigest(held[j : j + length]) for j in range(n[i])]
                yield columns(
                    {"code": np.array(code, np.uint64).view(np.int64),
                     "key": np.full(n[i], key[i]), "rid": np.full(n[i], rid[i]),
                     "p": p[i] + np.arange(n[i])}, ["code", "key", "rid", "p"])

    return run


def later_strings(length: int):
    """Spans of strings that are later than the first with their hash, in order of hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, int] | None = None
        for batch in batches:
            code, key, rid, p = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(code):
                continue
            fresh = np.concatenate([[last is None or code[0] != last[0]], code[1:] != code[:-1]])
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(code)), -1))
            old_key, old_p = key[first], p[first]
            if last is not None:
                old_key = np.where(first < 0, last[1], old_key)
                old_p = np.where(first < 0, last[2], old_p)
            last = (int(code[-1]), int(old_key[-1]), int(old_p[-1]))
            hit = np.flatnonzero((old_key < key) | ((old_key == key) & (old_p < p)))
            yield columns(merged(
                {"key": key[hit], "rid": rid[hit], "p": p[hit],
                 "n": np.ones(len(hit), np.int64)}, length), ["key", "rid", "p", "e"])

    return run


def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each document in order, overlaps and neighbours joined."""
    for batch in batches:
        starts, ends = [], []
        for row in batch.column(2):
            p, e = row.values.field("p").to_numpy(), row.values.field("e").to_numpy()
            order = np.argsort(p, kind="stable")
            p, e = p[order], np.maximum.accumulate(e[order])
            fresh = np.concatenate([[True], p[1:] > e[:-1]])
            at = np.flatnonzero(fresh)
            starts.append(p[at])
            ends.append(e[np.append(at[1:], len(p)) - 1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(starts, pa.list_(pa.int64())),
             pa.array(ends, pa.list_(pa.int64()))], names=["key", "rid", "starts", "ends"])


def keyed(docs: DataFrame) -> DataFrame:
    """`docs` with key (the id, null smallest) and rid, which tells rows of one id apart."""
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({
        "key": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
        "rid": F.xxhash64(text) if repeated else F.lit(0).cast("long"),
    })


def removed_spans(
    base: DataFrame, length: int = LENGTH, most_segments: int = MOST_SEGMENTS,
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """(key, rid, starts, ends) of the bytes to remove, from rows (key, rid, text)."""
    names = "h long, seg long, key long, rid long, p long, n long, o long, e long"
    found = mapped(base.select("key", "rid", "text"), scan(length), names)
    met = (
        found.repartition("h", F.when(F.col("e") >= 0, F.col("key")))
        .sortWithinPartitions("h", "seg", "key", "p"))
    sorted_out = cut(
        mapped(met, sort_out(length, most_rows), ", ".join(f"{n} long" for n in OUT)), "repeats-met")
    spans = sorted_out.where("e >= 0").select("key", "rid", "p", "e")
    listed = sorted_out.where("e < 0").groupBy("key", "rid").agg(
        F.collect_list(F.struct("h", "p", "n", "o", "kinds")).alias("wanted"))
    cuts = mapped(
        base.select("key", "rid", "text").join(listed, ["key", "rid"])
        .select("key", "rid", "text", "wanted"),
        cut_out(length),
        "h long, key long, rid long, p long, n long, o long, kinds long, bytes binary")
    cuts = cut(cuts, "repeats-segments")
    few = cuts.where(F.col("kinds") <= most_segments).select(
        "h", "key", "rid", "p", "n", "o", "bytes")
    many = cuts.where(F.col("kinds") > most_segments).select(
        "h", "key", "rid", "p", "n", "o", "bytes")
    out = "key long, rid long, p long, e long"
    by_index = mapped(
        few.repartition("h").sortWithinPartitions("h"), indexed(length), out)
    strings = mapped(many, strings_of(length), "code long, key long, rid long, p long")
    by_string = mapped(
        strings.repartition("code").sortWithinPartitions("code", "key", "p"),
        later_strings(length), out)
    every = spans.unionByName(by_index).unionByName(by_string)
    return mapped(
        every.groupBy("key", "rid").agg(F.collect_list(F.struct("p", "e")).alias("spans")),
        join_up, "key long, rid long, starts array<long>, ends array<long>")


def spared(text: bytes, starts: np.ndarray, ends: np.ndarray, whole: bool) -> bytes:
    """What is left of a text; `whole` keeps characters that a span holds only in part."""
    if not len(starts):
        return text
    held = np.frombuffer(text, np.uint8)
    keep = np.ones(len(held), bool)
    for a, b in zip(starts, ends, strict=True):
        if whole:
            while a < b and held[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(held) and held[b] & 0xC0 == 0x80:
                b -= 1
        keep[a:b] = False
    return held[keep].tobytes()


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of `docs` (with key and rid) and their starts and ends, empty if none."""
    empty = F.array().cast("array<long>")
    return docs.join(spans, ["key", "rid"], "left").withColumns({
        "starts": F.coalesce("starts", empty), "ends": F.coalesce("ends", empty)})


def rest_of(whole: bool):
    """A column function (text, starts, ends) of the bytes that are left."""

    @F.pandas_udf("binary")
    def rest(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([
            spared(t.encode(), a, b, whole) for t, a, b in zip(text, starts, ends, strict=True)])

    return rest


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, starts, ends of the removed spans, and kept (binary) of every row."""
    base = keyed(docs.select("doc_id", "text")).select(
        "key", "rid", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = with_spans(base, removed_spans(base, length))
    return found.select(
        F.nullif("key", F.lit(NULL_ID)).alias("doc_id"),
        F.octet_length("text").cast("long").alias("n_bytes"), "starts", "ends",
        rest_of(False)("text", "starts", "ends").alias("kept"))


def shortened(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` with repeats taken out of text, and n_chars, if there, to match.

    Characters of which a span holds only some bytes stay. Other columns pass unchanged.
    """
    names = docs.columns
    base = keyed(docs.select("doc_id", "text")).select(
        "key", "rid", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spans = removed_spans(base, length)
    row = docs.select(F.struct(*names).alias("row"), "doc_id", "text")
    found = with_spans(keyed(row), spans)
    text = F.col("row")["text"]
    rest = F.when(F.size("starts") == 0, text).otherwise(
        rest_of(True)(F.coalesce(text.cast("string"), F.lit("")), "starts", "ends")
        .cast("string"))
    changed = found.withColumn("rest", rest)
    kept = []
    for name in names:
        column = F.col("row")[name]
        if name == "text":
            column = F.col("rest")
        elif name == "n_chars":
            column = F.when(F.size("starts") == 0, column).otherwise(
                F.char_length("rest").cast(docs.schema[name].dataType))
        kept.append(column.alias(name))
    return changed.select(*kept)
