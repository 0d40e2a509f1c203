"""Every batch query against its SQL, and the contract's shape."""

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF
from tillwater.plans.feeds import FEEDS
from tillwater.plans.queries import BATCH
from tillwater.plans.replay import STREAMING

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
CHECKED = [*BATCH, *STREAMING, *FEEDS]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", CHECKED)
def test_same_answer_as_sql(spark, sql, name):
    frame = contract.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    result = sql.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=str)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=str)
    assert got == want and got


def test_every_query_has_sql():
    assert {*BATCH, *STREAMING, *FEEDS} <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["stt", "edt", "sku_id"]
