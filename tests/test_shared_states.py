"""Many keys in one state: the rules of one key, few calls, and state that is read back."""

import datetime as dt
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_waiting import _List, _Now, _Value
from tillwater.plans.feeds import Waves, _closing
from tillwater.streaming.answers import MET, WAITED_OUT, WaitingMany, answered, waiting_state
from tillwater.streaming.firsts import FirstEver
from tillwater.streaming.state import Chunks

T0 = dt.datetime(2024, 3, 1)


class _Counted(_List):
    def __init__(self):
        super().__init__()
        self.calls = 0

    def appendList(self, items):  # noqa: N802
        self.calls += 1
        super().appendList(items)


class _Handle:
    def __init__(self):
        self.lists, self.value, self.timers = {}, _Value(), []

    def getValueState(self, name, schema):  # noqa: N802
        return self.value

    def getListState(self, name, schema):  # noqa: N802
        return self.lists.setdefault(name, _Counted())

    def registerTimer(self, ms):  # noqa: N802
        self.timers.append(ms)

    def rows(self, name):
        return sorted((row for e in self.lists[name].items for row in json.loads(e[0])), key=str)


def _batch(*given):
    return iter([pd.DataFrame(
        given, columns=["key", "is_fact", "text", "ms", "until", "us", "tie"])])


def _out(frames):
    return sorted((tuple(r) for f in frames for r in f.itertuples(index=False)), key=str)


def test_keys_of_one_state_keep_apart():
    handle, waiting = _Handle(), WaitingMany()
    waiting.init(handle)
    first = _batch(
        ("a", True, "a1", 10, 500, 0, 0), ("b", True, "b1", 20, 300, 0, 0),
        ("b", True, "b-late", 20, 90, 0, 0), (None, True, "n1", 10, 500, 0, 0),
        ("a", False, "old", 0, 800, 5, 1), ("a", False, "new", 0, 800, 7, 1))
    assert _out(waiting.handleInputRows((0,), first, _Now(100))) == [
        ("a1", "new", MET), ("b-late", None, WAITED_OUT)]
    assert handle.timers == [300] and handle.value.get() == (300,)
    # An older answer counts for nothing; b's comes; a fact after a's end waits.
    second = _batch(
        ("a", False, "older", 0, 900, 6, 1), ("b", False, "bee", 0, 400, 1, 1),
        ("a", True, "a2", 850, 900, 0, 0), ("b", True, "b2", 399, 450, 0, 0))
    assert _out(waiting.handleInputRows((0,), second, _Now(200))) == [
        ("b1", "bee", MET), ("b2", "bee", MET)]
    assert handle.rows("held_chunks") == [["a", "a2", 850, 900], [None, "n1", 10, 500]]
    # The first timer finds only the next ones to set.
    assert _out(waiting.handleExpiredTimer((0,), _Now(301), None)) == []
    assert handle.value.get() == (400,)
    assert _out(waiting.handleExpiredTimer((0,), _Now(900), None)) == [
        ("a2", None, WAITED_OUT), ("n1", None, WAITED_OUT)]
    assert handle.rows("known_chunks") == [] and handle.value.get() is None


def test_thousands_of_keys_take_a_few_calls():
    handle, waiting = _Handle(), WaitingMany()
    waiting.init(handle)
    facts = [(f"k{i}", True, f"f{i}", i, 10**6, 0, 0) for i in range(3 * Chunks.ROWS)]
    answers = [(f"k{i}", False, f"a{i}", 0, 10**7, 1, 1) for i in range(3 * Chunks.ROWS)]
    assert _out(waiting.handleInputRows((0,), _batch(*facts), _Now(0))) == []
    assert handle.lists["held_chunks"].calls == 1 and len(handle.lists["held_chunks"].items) == 3
    assert len(_out(waiting.handleInputRows((0,), _batch(*answers), _Now(0)))) == len(facts)
    assert handle.lists["known_chunks"].calls == 1 and handle.timers == [10**6]


def test_chunks_of_small_batches_are_put_together():
    handle, waiting = _Handle(), WaitingMany()
    waiting.init(handle)
    for i in range(40):
        given = _batch((f"k{i % 5}", False, f"a{i}", 0, 10**7, i, 1))
        assert _out(waiting.handleInputRows((0,), given, _Now(0))) == []
    assert len(handle.lists["known_chunks"].items) < 20
    asked = _batch(*[(f"k{i}", True, f"f{i}", 1, 10**6, 0, 0) for i in range(5)])
    assert _out(waiting.handleInputRows((0,), asked, _Now(0))) == [
        (f"f{i}", f"a{35 + i}", MET) for i in range(5)]


def test_visitors_of_one_state_are_first_once():
    handle, first = _Handle(), FirstEver()
    first.init(handle)
    names = ["first_key", "first_us", "first_tie", "first_wt", "first_row"]

    def given(*records):
        frame = pd.DataFrame(
            [(k, us, tie, pd.Timestamp(us, unit="us"), "{}") for k, us, tie in records],
            columns=names)
        return [frame.iloc[:2], frame.iloc[2:]]

    out = [r[:3] for r in _out(first.handleInputRows(
        (0,), given(("a", 9, 1), ("b", 5, 2), ("a", 9, 0), (None, 7, 1), (None, 7, 2)), None))]
    assert out == [("a", 9, 0), ("b", 5, 2), (None, 7, 1)]
    out = [r[:3] for r in _out(first.handleInputRows(
        (0,), given(("c", 3, 1), ("a", 1, 1), (None, 1, 1)), None))]
    assert out == [("c", 3, 1)]


@pytest.mark.parametrize("layouts", [(3, 5), (None, 4), (2, None)])
def test_a_query_goes_on_from_either_layout(spark, layouts):
    """State of shared states and of one state for each key, read by the other."""
    time = lambda s: T0 + dt.timedelta(seconds=s)
    facts = lambda *given: spark.createDataFrame(
        [(i, k, None if s is None else time(s)) for i, k, s in given], "id long, k string, et timestamp")
    table = lambda *given: spark.createDataFrame(
        [(k, n, time(s), 0) for k, n, s in given],
        "k string, name string, changed timestamp, place long")

    def query(states, spread, resume=None):
        waves = Waves(spark, "either", facts=facts((0, "a", 0)).schema, table=table(("a", "", 0)).schema)
        stream = waves.stream("facts").withWatermark("et", "10 seconds")
        return waves, answered(
            stream.withColumn("et", F.timestamp_micros(F.unix_micros("et"))), F.col("k"),
            F.col("et"), F.col("et") + F.expr("INTERVAL 600 SECONDS"), waves.stream("table"),
            F.col("k"), (F.col("changed"), F.col("place")), spread=spread, resume=resume,
            states=states)

    waves, met = query(layouts[0], 2)
    waves.add(
        facts=facts((1, "ä", 0), (2, "b", 1), (3, 'c"', 2), (4, None, 3)),
        table=table(("ä", "new \\ \n", 2), ("ä", "old", 1)))
    one = waves.to_rows(met, 2)
    assert rows(one, "id", "answer.name", "outcome") == [(1, "new \\ \n", "met")]
    state = waiting_state(spark, f"{waves.base}/checkpoint")
    assert rows(state.filter("is_fact"), "key") == [("b",), ('c"',), (None,)]
    waves, met = query(layouts[1], 3, state)
    waves.add(
        facts=facts((5, "ä", 5), (6, 'c"', 6), (7, "b", None), (8, 'c"', None)), table=table(("b", "bee", 1), ("ä", "older", 0)))
    waves.to_rows(met, 3)
    waves.add(facts=_closing(facts((0, "a", 0)), id=-1, k="end", et=dt.datetime(2200, 1, 1)),
              table=table())
    two = waves.to_rows(met, 3)
    assert rows(two.filter("id > 0"), "id", F.col("answer.name").alias("n"), "outcome") == [
        (2, "bee", "met"), (3, None, "waited out"), (4, None, "waited out"),
        (5, "new \\ \n", "met"), (6, None, "waited out"),
        (7, "bee", "met"), (8, None, "waited out")]
