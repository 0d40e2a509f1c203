"""License scan: an Aho-Corasick pass over phrases, and SPDX expressions by shunting-yard.

Each text is lower-cased (A-Z only) and cut into words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`.
An automaton over the words, joined by single spaces, finds every place of every
notice phrase, overlapping ones too. A second automaton finds identifier tags in the
unsplit text; the expression behind a tag is parsed with operator precedence
`with` > `and` > `or` and parentheses.

Defined cases: a null text is empty; an empty text has 0 words, no labels and score
NEUTRAL; repeated rows give repeated results; a null doc_id is returned as null;
other columns are never read. An expression ends at the first token that cannot
continue it; a tag without a readable expression gives the label `unreadable-tag`.
The score is how freely the text may be used, 1 (public domain) to 0 (reserved): the
least free of everything found, where `or` takes the freer side and `and` the less free.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tillwater.llm.common import mapped, texts

#: Score of a text in which nothing is found, and of an identifier that isn't listed.
NEUTRAL = 0.5

# The base phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Wording of well-known notices, as words.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "mit license": "mit",
    "apache license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "creative commons": "creative-commons",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "the unlicense": "unlicense",
    "isc license": "isc",
    "proprietary and confidential": "proprietary",
}
# How freely a text under each label or identifier family may be used.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0,
    "mit": 0.9, "apache": 0.9, "bsd": 0.9, "isc": 0.9, "zlib": 0.9, "bsl": 0.9,
    "cc-by": 0.8, "creative-commons": 0.6, "mpl": 0.6, "epl": 0.6, "lgpl": 0.6,
    "cc-by-sa": 0.4, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.2,
    "reserved": 0.0, "proprietary": 0.0,
}
TAGS = ("spdx-license-identifier:", "license-expression:")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: An exception named by `with` gives this much freedom back.
EXCEPTION_BONUS = 0.1
TOKEN = re.compile(r"[ \t]*(?:([()])|([a-z0-9][a-z0-9.+\-]*))")
# Every ASCII byte but digits and lower-case letters parts words.
PARTS_WORDS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


@dataclass
class Terms:
    """What an expression says: its identifiers and how freely it lets one use the text."""

    labels: set[str]
    freedom: float


def family(identifier: str) -> float:
    """Freedom of an identifier by its longest listed beginning: gpl-3.0-only is gpl."""
    name = identifier.rstrip("+")
    while name:
        if name in FREEDOM:
            return FREEDOM[name]
        name = name.rpartition("-")[0]
    return NEUTRAL


def combined(operator: str, left: float, right: float) -> float:
    if operator == "or":
        return max(left, right)
    if operator == "and":
        return min(left, right)
    return min(1.0, left + EXCEPTION_BONUS)


def complete_tokens(text: str, at: int) -> tuple[list[str], int]:
    """The tokens of the longest complete expression from `at`, and its end."""
    tokens: list[str] = []
    depth, whole, end, wants_operand = 0, 0, at, True
    while token := TOKEN.match(text, at):
        bracket, word = token.groups()
        if wants_operand and bracket == "(":
            depth += 1
        elif wants_operand and word and word not in PRECEDENCE:
            wants_operand = False
        elif not wants_operand and bracket == ")" and depth:
            depth -= 1
        elif not wants_operand and word in PRECEDENCE:
            wants_operand = True
        else:
            break
        tokens.append(bracket or word)
        at = token.end()
        if not wants_operand and not depth:
            whole, end = len(tokens), at
    return tokens[:whole], end


def read_expression(text: str, at: int = 0) -> tuple[Terms | None, int]:
    """The longest readable expression from `at`; None if there is none. Also its end.

    Each token is read once and each operator applied once, however long it is.
    """
    tokens, end = complete_tokens(text, at)
    operands: list[float] = []
    operators: list[str] = []
    labels: set[str] = set()

    def reduce_top() -> None:
        right = operands.pop()
        operands.append(combined(operators.pop(), operands.pop(), right))

    for token in tokens:
        if token == "(":
            operators.append(token)
        elif token == ")":
            while operators[-1] != "(":
                reduce_top()
            operators.pop()
        elif token in PRECEDENCE:
            while operators and PRECEDENCE.get(operators[-1], 0) >= PRECEDENCE[token]:
                reduce_top()
            operators.append(token)
        else:
            identifier = token.rstrip(".")
            labels.add(identifier)
            operands.append(family(identifier))
    while operators:
        reduce_top()
    return (Terms(labels, operands[0]) if operands else None), end


def automaton(patterns: dict[str, object]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        built.add_word(pattern, (len(pattern), value))
    built.make_automaton()
    return built


def scanner(extra_phrases: dict[str, str] | None = None):
    """A function of one text's bytes that returns a result row."""
    notices = {**NOTICE_PHRASES, **(extra_phrases or {})}
    phrases = {f" {p} ": (label, False) for p, label in notices.items()}
    phrases |= {f" {p} ": (label, True) for p, label in BASE_PHRASES.items()}
    in_words = automaton(phrases)
    in_text = automaton({tag: tag for tag in TAGS})

    def scan(raw: bytes) -> tuple:
        lowered = raw.lower()  # bytes: A-Z only
        words = lowered.translate(PARTS_WORDS).split()
        # One character per byte, so that places are byte places.
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        base_at: list[int] = []
        base: set[str] = set()
        found: set[str] = set()
        known = at = 0
        for end, (length, (label, is_base)) in in_words.iter(line):
            found.add(label)
            if is_base:
                base.add(label)
                start = end - length + 1
                base_at.append(start)
        freedom = [FREEDOM.get(x, NEUTRAL) for x in found]
        expressions: list[str] = []
        text = lowered.decode("latin-1")
        for end, _ in in_text.iter(text):
            terms, stop = read_expression(text, end + 1)
            if terms is None:
                found.add("unreadable-tag")
            else:
                found |= terms.labels
                freedom.append(terms.freedom)
                expressions.append(" ".join(text[end + 1 : stop].split()))
        first = last = None
        if base_at:
            base_at.sort()
            places = []
            for start in (base_at[0], base_at[-1]):
                known += line.count(" ", at, start)
                at = start
                places.append(known)
            first, last = places
        return (
            len(words), len(base_at), first, last, ",".join(sorted(base)),
            ",".join(sorted(found)), float(min(freedom, default=NEUTRAL)), expressions,
        )

    return scan


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, expressions array<string>"
)


def scan_licenses(docs: DataFrame, extra_phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per row of `docs`: words, base places, labels, expressions and a score."""
    names = [field.strip().split()[0] for field in SCHEMA.split(",")]
    kinds = [
        pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
        pa.float64(), pa.list_(pa.string()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(extra_phrases)
        for batch in batches:
            rows = [scan(t.as_buffer().to_pybytes()) for t in batch.column(1)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    return mapped(texts(docs), run, SCHEMA)
