import tempfile

import pytest
from pyspark.sql import functions as F

from tillwater.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A fresh folder per test; nothing is cleared."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def visits(spark, records):
    """(mid, ts millis, last_page_id) as page records, `tie` in the given order."""
    data = [(i, mid, ts, last) for i, (mid, ts, last) in enumerate(records)]
    frame = spark.createDataFrame(data, "tie long, mid string, ts long, last string")
    return frame.withColumn("et", F.timestamp_millis("ts"))
