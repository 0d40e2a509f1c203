"""The waiting operator's work on one key, without Spark."""

import pandas as pd

from tillwater.streaming.answers import MET, WAITED_OUT, Waiting


class _Value:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = tuple(value)

    def clear(self):
        self.value = None


class _List:
    def __init__(self):
        self.items = []

    def exists(self):
        return bool(self.items)

    def get(self):
        return iter(self.items)

    def put(self, items):
        self.items = list(items)

    def appendList(self, items):  # noqa: N802
        self.items += list(items)

    def clear(self):
        self.items = []


class _Handle:
    def __init__(self):
        self.value, self.list, self.timers = _Value(), _List(), []

    def getValueState(self, name, schema):  # noqa: N802
        return self.value

    def getListState(self, name, schema):  # noqa: N802
        return self.list

    def registerTimer(self, ms):  # noqa: N802
        self.timers.append(ms)


class _Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def _rows(*given):
    return pd.DataFrame(given, columns=["is_fact", "text", "ms", "until", "us", "tie"])


def test_one_key_leaves_in_one_frame_with_each_outcome():
    handle, waiting = _Handle(), Waiting()
    waiting.init(handle)
    # Held from before: 1 is met by the answer to come, 2 is after its end.
    handle.list.put([("held-1", 10, 500), ("held-2", 900, 950)])
    batch = _rows(
        (True, "new-3", 20, 600, 0, 0), (True, "late-4", 950, 90, 0, 0),
        (False, "old", 0, 800, 5, 1), (False, "new", 0, 800, 7, 1), (False, "tied", 0, 800, 7, 1))
    frames = list(waiting.handleInputRows(("k",), iter([batch]), _Now(100)))
    assert len(frames) == 1
    assert sorted(map(tuple, frames[0].itertuples(index=False))) == [
        ("held-1", "tied", MET), ("late-4", None, WAITED_OUT), ("new-3", "tied", MET)]
    assert handle.value.get() == ("tied", 7, 1, 800)
    assert handle.list.items == [("held-2", 900, 950)]
