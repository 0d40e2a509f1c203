"""Page jumps: the golden stream, the edges, and a plain-Python rule."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows, visits
from tillwater.operators.jumps import TIMEOUT_ONLY, user_jump

GOLDEN = [
    ("101", 10_000, None), ("101", 11_000, None),
    ("102", 10_000, None), ("102", 14_000, "home"), ("102", 50_000, "detail"),
]


def entry():
    return F.coalesce("last", F.lit("")) == ""


def jumps(pages, **options):
    return user_jump(pages, "mid", "et", entry(), "tie", **options)


def rule(records, within=5_000, timeout_only=False):
    """Ties of the jumps, straight from the definition."""
    out = []
    for tie, (mid, ts, last) in enumerate(records):
        if last:
            continue
        later = sorted(
            (t, i, l) for i, (m, t, l) in enumerate(records) if m == mid and (t, i) > (ts, tie)
        )
        late = not later or later[0][0] - ts >= within
        if late or (not timeout_only and not later[0][2]):
            out.append((tie,))
    return sorted(out, key=str)


def test_golden_stream(spark):
    pages = visits(spark, GOLDEN)
    assert rows(jumps(pages), "mid", "ts") == [("101", 10_000), ("101", 11_000)]
    assert rows(jumps(pages, mode=TIMEOUT_ONLY), "mid", "ts") == [("101", 11_000)]


def test_exactly_the_limit_is_too_late(spark):
    pages = visits(spark, [("m", 0, None), ("m", 5_000, "p"), ("n", 0, ""), ("n", 4_999, "p")])
    assert rows(jumps(pages), "mid", "ts") == [("m", 0)]


def test_followers_across_a_chunk_boundary_count(spark):
    pages = visits(spark, [("m", 9_999, None), ("m", 10_001, "p")])
    assert jumps(pages, chunk="10 seconds").count() == 0
    pages = visits(spark, [("m", 9_999, None), ("m", 14_998, None), ("m", 14_999, "p")])
    assert rows(jumps(pages, chunk="10 seconds"), "ts") == [(9_999,)]


def test_records_come_out_whole(spark):
    pages = visits(spark, GOLDEN)
    assert jumps(pages).columns == pages.columns


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        jumps(visits(spark, GOLDEN), mode="other")


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    records=st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 40_000), st.sampled_from([None, "", "p"])),
        max_size=25,
    ),
    chunk=st.sampled_from(["5 seconds", "7 seconds", "1 minute", None]),
    timeout_only=st.booleans(),
)
def test_jumps_follow_the_rule(spark, records, chunk, timeout_only):
    options = {"mode": TIMEOUT_ONLY} if timeout_only else {}
    got = jumps(visits(spark, records), chunk=chunk, **options)
    assert rows(got, "tie") == rule(records, timeout_only=timeout_only)


def test_a_hot_visitor_is_spread_over_chunks(spark):
    """One visitor, many chunks: the shuffle key has the chunk in it."""
    pages = visits(spark, [("hot", 1_000 * i, None if i % 3 == 0 else "p") for i in range(900)])
    plan = jumps(pages, chunk="10 seconds")
    text = plan._jdf.queryExecution().executedPlan().toString()
    shuffles = [l for l in text.splitlines() if "hashpartitioning(" in l]
    assert len(shuffles) == 1 and "_start" in shuffles[0] and "_key" in shuffles[0]
    assert plan.count() == 0
