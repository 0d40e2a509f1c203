"""Facts that wait in keyed state for a row of their key from another stream.

Facts and answers are one stream to the state, so neither side can be let go of before
the other, however long the stream was quiet. A fact whose answer is known leaves at
once; the others wait, each until its own event time, and leave marked if none came.
Late records are not dropped: one whose time to wait is over leaves with what is known.

A call into the state costs about as much as the work on hundreds of rows. So many keys share
a state (`WaitingMany`), which keeps its rows in chunks, a few values for thousands of facts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillwater.functions import micros
from tillwater.streaming.state import Chunks, chunk_rows, has_variable, state_variable

#: What became of a fact.
MET, WAITED_OUT = "met", "waited out"
# Keeps microseconds when a record passes the state as text.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_OUT = ["fact", "answer", "outcome"]
_OUT_SCHEMA = "fact string, answer string, outcome string"
_IN = ["is_fact", "text", "ms", "until", "us", "tie"]
_FOREVER = (1 << 62) // 1000
#: States that the keys share by default.
STATES = 1024
# Chunks of answers in a state, after which they are put together again.
_MANY_CHUNKS = 16


class Waiting(StatefulProcessor):
    """The newest answer of a key, for as long as it lives, and the facts that wait for one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._known = handle.getValueState("known", "answer string, us long, tie long, until long")
        self._held = handle.getListState("held", "fact string, ms long, until long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        rows = _records(initialState, _IN)
        held = [(text, int(ms), int(until)) for is_fact, text, ms, until, _, _ in rows if is_fact]
        if held:
            self._held.appendList(held)
            self._handle.registerTimer(min(f[2] for f in held))
        known = [row for row in rows if not row[0]]
        if known:
            _, text, _, until, us, tie = known[0]
            self._known.update((text, int(us), int(tie), int(until)))
            if until < _FOREVER:
                self._handle.registerTimer(int(until))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Plain lists: a key's rows are few, and pandas costs more than the work on them.
        now = timerValues.getCurrentWatermarkInMs()
        come, newest = [], None
        # A batch's changes count before its facts, in whatever order they come.
        for frame in rows:
            for is_fact, text, ms, until, us, tie in _records(frame, _IN):
                if is_fact:
                    come.append((text, ms, until))
                elif newest is None or (newest[1], newest[2]) <= (us, tie):
                    newest = (text, us, tie, until)
        known = self._known.get()
        out: list[tuple[str, str | None, str]] = []
        if newest is not None:
            if known is None or (known[1], known[2]) <= (newest[1], newest[2]):
                known = newest
                if known[3] > now:
                    self._known.update(known)
                    if known[3] < _FOREVER:
                        self._handle.registerTimer(known[3])
            if self._held.exists():
                held = list(self._held.get())
                rest = [f for f in held if f[1] >= known[3]]
                if len(rest) < len(held):
                    out += [(f[0], known[0], MET) for f in held if f[1] < known[3]]
                    self._held.put(rest) if rest else self._held.clear()
        if known is not None:
            out += [(f[0], known[0], MET) for f in come if f[1] < known[3]]
            come = [f for f in come if f[1] >= known[3]]
        out += [(f[0], None, WAITED_OUT) for f in come if f[2] <= now]
        come = [f for f in come if f[2] > now]
        if come:
            self._held.appendList(come)
            # One timer for the first of them; it sets the next.
            self._handle.registerTimer(min(f[2] for f in come))
        if out:
            yield pd.DataFrame(out, columns=_OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        known = self._known.get()
        if known is not None and known[3] <= now:
            self._known.clear()
        held = list(self._held.get()) if self._held.exists() else []
        over = [fact for fact, _, until in held if until <= now]
        if over:
            rest = [f for f in held if f[2] > now]
            if rest:
                self._held.put(rest)
                self._handle.registerTimer(min(f[2] for f in rest))
            else:
                self._held.clear()
            yield _left(over, None, WAITED_OUT)

    def close(self) -> None:
        pass


class WaitingMany(StatefulProcessor):
    """`Waiting` for all keys of a bucket, by the same rules.

    The state holds chunks of rows: (key, answer, us, tie, until), of which a key's last one
    counts, and (key, fact, ms, until). A batch adds a chunk for what is new in it; what is
    held is only read when an answer comes or the first time to wait is over.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._known = Chunks(handle.getListState("known_chunks", Chunks.SCHEMA))
        self._held = Chunks(handle.getListState("held_chunks", Chunks.SCHEMA))
        # The earliest timer that is set. Later ones that it replaced find nothing to do.
        self._next = handle.getValueState("next", "ms long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        known, held = [], []
        for k, is_fact, text, ms, until, us, tie in _records(initialState, ["key", *_IN]):
            if is_fact:
                held.append((k, text, int(ms), int(until)))
            else:
                known.append((k, text, int(us), int(tie), int(until)))
        self._known.add(known)
        self._held.add(held)
        self._wake([f[3] for f in held] + [a[4] for a in known])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        come, newest = [], {}
        # A batch's changes count before its facts, in whatever order they come.
        for frame in rows:
            for k, is_fact, text, ms, until, us, tie in _records(frame, ["key", *_IN]):
                if is_fact:
                    come.append((k, text, ms, until))
                elif k not in newest or newest[k][1:3] <= (us, tie):
                    newest[k] = (text, us, tie, until)
        known, chunks = self._answers()
        changed = {
            k: row for k, row in newest.items() if k not in known or known[k][1:3] <= row[1:3]}
        known.update(changed)
        kept = [(k, *row) for k, row in changed.items() if row[3] > now]
        if kept and chunks >= _MANY_CHUNKS:
            self._known.put([(k, *row) for k, row in known.items() if row[3] > now])
        else:
            self._known.add(kept)
        out: list[tuple[str, str | None, str]] = []
        if changed:
            held = self._held.get()
            met = [f[0] in changed and f[2] < changed[f[0]][3] for f in held]
            if any(met):
                out += [(f[1], changed[f[0]][0], MET) for f, m in zip(held, met) if m]
                self._held.put([f for f, m in zip(held, met) if not m])
        left = []
        for fact in come:
            answer = known.get(fact[0])
            if answer is not None and fact[2] < answer[3]:
                out.append((fact[1], answer[0], MET))
            elif fact[3] <= now:
                out.append((fact[1], None, WAITED_OUT))
            else:
                left.append(fact)
        self._held.add(left)
        self._wake([f[3] for f in left] + [a[4] for a in kept])
        if out:
            yield pd.DataFrame(out, columns=_OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        due = self._next.get()
        if due is None or due[0] > now:
            return
        self._next.clear()
        known, _ = self._answers()
        living = [(k, *row) for k, row in known.items() if row[3] > now]
        if len(living) < len(known):
            self._known.put(living)
        held = self._held.get()
        rest = [f for f in held if f[3] > now]
        if len(rest) < len(held):
            self._held.put(rest)
        self._wake([f[3] for f in rest] + [a[4] for a in living])
        over = [f[1] for f in held if f[3] <= now]
        if over:
            yield _left(over, None, WAITED_OUT)

    def close(self) -> None:
        pass

    def _answers(self) -> tuple[dict, int]:
        rows, chunks = self._known.read()
        return {row[0]: tuple(row[1:]) for row in rows}, chunks

    def _wake(self, times: list[int]) -> None:
        """Set a timer for the first of these times, unless there is an earlier one."""
        first = min((t for t in times if t < _FOREVER), default=None)
        if first is None:
            return
        due = self._next.get()
        if due is None or first < due[0]:
            self._handle.registerTimer(first)
            self._next.update((first,))


def _records(frame: pd.DataFrame, columns: list[str]) -> list[tuple]:
    """The frame's rows as tuples of plain Python values."""
    return list(zip(*(frame[c].tolist() for c in columns)))


def _left(facts, answer: str | None, outcome: str) -> pd.DataFrame:
    out = pd.DataFrame({"fact": list(facts)})
    out["answer"], out["outcome"] = answer, outcome
    return out[_OUT]


def answered(
    facts: DataFrame, fact_key: Column, at: Column, until: Column,
    answers: DataFrame, answer_key: Column, place: tuple[Column, Column],
    lifetime: str | None = None, spread: int = 1, resume: DataFrame | None = None,
    states: int | None = STATES,
) -> DataFrame:
    """Each row of `facts`, the newest answer of its key as `answer`, and its `outcome`.

    A fact of time `at` waits until the watermark passes the time `until`. Of a key's
    answers the one with the greatest `place` (a time, then a number) counts, for facts
    before its end: `lifetime` after that time, or never. Facts of one key are spread over `spread` states, each
    with a copy of the answer, so that a key with very many facts isn't one task's.
    Keys are dealt to `states` states by their hash; None gives each key one of its own,
    which is slower by far. More of them suit many keys and small batches, since a batch
    reads the answers of each state that it touches. A batch's facts of one state are
    held in memory once, and those that wait there, when an answer comes to it.

    A fact without a time doesn't wait: it leaves with the answer known as it comes, or marked.
    An answer without a time comes before all others.

    `resume` is the state of a stopped query (`waiting_state`), from which this one goes
    on, with any `spread` and number of partitions; its inputs begin where the other's
    ended (`runner.stopped_at`).

    At least one side carries a watermark. It leaves with neither: give the result a
    watermark of its own where event time matters further on.
    """
    fact_row, answer_row = F.struct(*facts.columns), F.struct(*answers.columns)
    fact_type = _nullable(facts.select(fact_row.alias("r")).schema["r"].dataType)
    answer_type = _nullable(answers.select(answer_row.alias("r")).schema["r"].dataType)
    text = F.to_json(fact_row, JSON)
    asked = facts.select(
        fact_key.cast("string").alias("key"), F.lit(True).alias("is_fact"), text.alias("text"),
        F.unix_millis(at).alias("ms"), F.unix_millis(until).alias("until"),
    ).withColumn("part", F.pmod(F.xxhash64("text"), F.lit(spread)).cast("int")).withColumns(
        {"us": F.lit(0).cast("long"), "tie": F.lit(0).cast("long")})
    ends = F.lit(_FOREVER).cast("long")
    if lifetime:
        ends = F.unix_millis(place[0]) + micros(lifetime) // 1000
    given = answers.select(
        answer_key.cast("string").alias("key"), F.lit(False).alias("is_fact"),
        F.to_json(answer_row, JSON).alias("text"), F.lit(0).cast("long").alias("ms"),
        ends.alias("until"),
        F.unix_micros(place[0]).alias("us"), place[1].cast("long").alias("tie"),
        F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"))
    both = asked.unionByName(given).withColumns(
        {c: F.coalesce(c, F.lit(-_FOREVER)) for c in ("ms", "until", "us", "tie")})
    if resume is not None:
        part = F.when(F.col("is_fact"), F.array(F.pmod(F.xxhash64("text"), F.lit(spread)).cast(
            "int"))).otherwise(F.sequence(F.lit(0), F.lit(spread - 1)))
        resume = resume.withColumn("part", F.explode(part))
    if states is None:
        processor, keys = Waiting(), ["key", "part"]
    else:
        processor, keys = WaitingMany(), ["bucket"]
        bucket = F.pmod(F.xxhash64("key", "part"), F.lit(states)).cast("int")
        both = both.withColumn("bucket", bucket).drop("part")
        if resume is not None:
            resume = resume.withColumn("bucket", bucket).drop("part")
    # No column here is an event time, so Spark holds nothing to be late.
    left = both.groupBy(*keys).transformWithStateInPandas(
        processor, _OUT_SCHEMA, "Append", "EventTime",
        initialState=None if resume is None else resume.groupBy(*keys))
    return left.select(
        F.from_json("fact", fact_type, JSON).alias("f"),
        F.from_json("answer", answer_type, JSON).alias("answer"), "outcome",
    ).select("f.*", "answer", "outcome")


def waiting_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a stopped query of `answered` knows and holds, a row for each answer and fact."""
    none = F.lit(0).cast("long")
    if has_variable(spark, checkpoint, "held_chunks"):
        held = chunk_rows(spark, checkpoint, "held_chunks", "key string", "text string", "ms long",
                          "until long")
        known = chunk_rows(spark, checkpoint, "known_chunks", "key string", "text string",
                           "us long", "tie long", "until long")
    else:
        held = state_variable(spark, checkpoint, "held").select(
            "key.key", F.col("list_element.fact").alias("text"), "list_element.ms",
            "list_element.until")
        known = state_variable(spark, checkpoint, "known").select(
            "key.key", F.col("value.answer").alias("text"), "value.us", "value.tie", "value.until")
    # Each part of a key has the same answer, or an older one that no fact was held for.
    newest = Window.partitionBy("key").orderBy(F.col("us").desc(), F.col("tie").desc())
    return held.select(
        "key", F.lit(True).alias("is_fact"), "text", "ms", "until", none.alias("us"),
        none.alias("tie"),
    ).unionByName(known.withColumn("turn", F.row_number().over(newest)).filter("turn = 1").select(
        "key", F.lit(False).alias("is_fact"), "text", none.alias("ms"), "until", "us", "tie"))


def _nullable(kind: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in kind.fields])
