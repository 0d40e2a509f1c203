"""SentencePiece encoding and decoding by a table of distinct chunks.

In the models this serves no piece holds a white-space marker behind another character,
and normalising only turns spaces into markers. So nothing joins across the place before
a marker that follows a word: a text is cut there, each distinct marked word is segmented
once by the library, and the numbers of the words, in the order of the text, gather their
ids and their decoded bytes. `load` refuses a model for which this isn't so.

The table belongs to a task. It starts anew beyond MOST_CHUNKS words, which changes the
work and not the result. One table for the whole corpus would need every block's words and
texts to meet in a shuffle, which costs more than segmenting a word once more elsewhere.

Defined cases: a null text is empty; an empty text has no piece, so only the end id, if
asked for; the marker character itself counts as a space, as in the library; repeated rows
give repeated results; a null doc_id is returned as null; no rows give none; other columns
are never read. A long text is cut into its words part by part, so that a task holds about
PART characters as strings and 4 bytes a word beside the text; a single run
without spaces is given to the library whole, which takes some 100 bytes a character.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tillwater.llm.common import mapped, pieces, texts

MARKER = "▁"
#: Distinct words that a task's table holds at most.
MOST_CHUNKS = 400_000
#: Characters of a text that are cut into words, and words that are looked up, at once.
PART = 1 << 20
#: Holds leading, repeated and trailing spaces and characters that normalising may change.
PROBE = "  a Ａﬁ　é\t  b\n "
#: A marker that follows a word: where a text with repeated spaces is cut.
AFTER_WORD = re.compile("(?<=[^ ]) ")


@lru_cache(maxsize=2)
def load(model: str) -> sentencepiece.SentencePieceProcessor:
    """The model, once per worker; ValueError if its pieces can join words."""
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    if library.normalize(PROBE) != MARKER + PROBE.replace(" ", MARKER):
        raise ValueError("the model's normalising does more than mark spaces")
    if library.piece_to_id(MARKER) == library.unk_id():
        raise ValueError("the model has no piece for a marker alone")
    for i in range(library.vocab_size()):
        if MARKER in library.id_to_piece(i).lstrip(MARKER):
            raise ValueError(f"piece {i} joins words")
    return library


def parts(text: str, size: int = PART) -> Iterator[list[str]]:
    """The marked words of a text in order, each without its first marker."""
    text = text.replace(MARKER, " ")
    start = 0
    while start < len(text) or (start and start == len(text)):
        cut = AFTER_WORD.search(text, start + size) if start + size < len(text) else None
        end = cut.start() if cut else len(text)
        part = text[start:end]
        spaced = "  " in part or part.startswith(" ")
        yield AFTER_WORD.split(part) if spaced else part.split(" ")
        start = end + 1


class ChunkTable:
    """Number, ids and decoded bytes of every distinct word seen."""

    def __init__(self, model: str, most: int = MOST_CHUNKS):
        self.library, self.most = load(model), most
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.id_ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.raw, self.raw_ends = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The words' numbers; words not seen yet are segmented."""
        new = list(set(words).difference(self.number))
        if new:
            ids = self.library.encode(new, num_threads=1)
            if "" in self.number or "" in new:  # a marker with no word behind it
                ids = [i if w else [self.library.piece_to_id(MARKER)]
                       for w, i in zip(new, ids, strict=True)]
            # Decoding drops the first marker, which stands for a space after a word.
            decoded = [b" " + t.encode() for t in self.library.decode(ids)]
            first = len(self.number)
            self.number.update(zip(new, range(first, first + len(new)), strict=True))
            self.ids, self.id_ends = grown(
                self.ids, self.id_ends, np.concatenate([np.array(i, np.int32) for i in ids]), ids)
            self.raw, self.raw_ends = grown(
                self.raw, self.raw_ends, np.frombuffer(b"".join(decoded), np.uint8), decoded)
        return np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))


def grown(values, ends, more, items) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and their ends with those of further items."""
    further = ends[-1] + np.cumsum([len(i) for i in items])
    return np.concatenate([values, more]), np.concatenate([ends, further])


def gathered(values: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The values of the given items one after another."""
    starts, sizes = ends[numbers], ends[numbers + 1] - ends[numbers]
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def encode_texts(
    table: ChunkTable, given: list[str], size: int = PART,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts one after another and their ends, decoded bytes and their ends."""
    ids, raw = [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)]
    id_sizes, raw_sizes = np.zeros((2, len(given)), np.int64)
    words: list[str] = []
    owners: list[tuple[int, int]] = []

    def settle() -> None:
        if len(table.number) > table.most:
            table.clear()
        numbers = table.numbers(words)
        owner = np.repeat([o for o, _ in owners], [n for _, n in owners])
        for values, ends, out, sizes in (
            (table.ids, table.id_ends, ids, id_sizes), (table.raw, table.raw_ends, raw, raw_sizes),
        ):
            out.append(gathered(values, ends, numbers))
            np.add.at(sizes, owner, ends[numbers + 1] - ends[numbers])
        words.clear()
        owners.clear()

    for n, text in enumerate(given):
        for part in parts(text, size):
            words.extend(part)
            owners.append((n, len(part)))
            if len(words) >= size:
                settle()
    if words:
        settle()
    # The first word's marker is the library's own and not a space of the text.
    starts = (np.cumsum(raw_sizes) - raw_sizes)[raw_sizes > 0]
    decoded = np.delete(np.concatenate(raw), starts)
    return (np.concatenate(ids), np.cumsum(id_sizes),
            decoded, np.cumsum(raw_sizes - (raw_sizes > 0)))


def encode(
    docs: DataFrame, model: str, end: bool = True, most: int = MOST_CHUNKS, size: int = PART,
) -> DataFrame:
    """doc_id, ids (array of int) and decoded (text of the ids) of every row of `docs`.

    `model` is a path that the workers can read. `end` adds the model's end id, which
    decodes to nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model, most)
        closing = [table.library.eos_id()] if end else []
        for piece in pieces(batches):
            given = piece.column(1).to_pylist()
            ids, id_ends, decoded, ends = encode_texts(table, given, size)
            if closing:
                ids = np.insert(ids, id_ends, closing[0])
                id_ends = id_ends + np.arange(1, len(given) + 1)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0),
                 pa.ListArray.from_arrays(
                     pa.array(np.append(0, id_ends), pa.int32()), pa.array(ids)),
                 pa.StringArray.from_buffers(
                     len(given), pa.py_buffer(np.append(0, ends).astype(np.int32)),
                     pa.py_buffer(decoded))],
                names=["doc_id", "ids", "decoded"])

    return mapped(texts(docs), run, "doc_id long, ids array<int>, decoded string")
