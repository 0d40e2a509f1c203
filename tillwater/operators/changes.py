"""Database change records: cleaning, routing by config, column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillwater.functions import drop_bootstrap, keep_keys

# Fixed values of the routing config.
FACT_SINK = "kafka"
DIM_SINK = "hbase"
DEFAULT_PK = "id"


def clean_changes(changes: DataFrame, database: str) -> DataFrame:
    """Inserts and updates of one database that carry data.

    The bootstrap prefix is removed from the operation type only; the data
    stays as it is.
    """
    return changes.withColumn("type", drop_bootstrap("type")).filter(
        (F.col("database") == database)
        & F.col("table").isNotNull()
        & F.col("type").isin("insert", "update")
        & (F.size("data") > 0)
    )


# Operations of a config feed: rows of the snapshot, and the end of a row.
SNAPSHOT, DELETE = "r", "d"


def route_history(feed: DataFrame) -> DataFrame:
    """The config rows of a snapshot and its changes, with the times from which they hold.

    `feed` has the columns of a config row, `op`, and its place: `ts`, then `tie`. A row
    of (source_table, operate_type) holds from its change (`valid_from`; the snapshot's
    from ever, null) until the next one of its key (`valid_to`; null if there is none).
    A deletion ends a row and starts none.
    """
    order = Window.partitionBy("source_table", "operate_type").orderBy("ts", "tie")
    first = F.row_number().over(order) == 1
    return feed.withColumns({
        "valid_from": F.when(~(first & (F.col("op") == SNAPSHOT)), F.col("ts")),
        "valid_to": F.lead("ts").over(order),
    }).filter(F.col("op") != DELETE).filter(
        "valid_from IS NULL OR valid_to IS NULL OR valid_from < valid_to").drop("op", "ts", "tie")


def match_routes(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Attach the config row for (table, type); records without one vanish.

    With a history of the config it is the row that held at the record's `ts`. Spark
    broadcasts the config by its size; nothing is forced.
    """
    config = routes.withColumnsRenamed({"source_table": "table", "operate_type": "type"})
    if "valid_from" not in config.columns:
        return changes.join(config, ["table", "type"])
    config = config.withColumnsRenamed({"table": "_table", "type": "_type"})
    held = (
        (F.col("table") == F.col("_table")) & (F.col("type") == F.col("_type"))
        & (F.col("valid_from").isNull() | (F.col("ts") >= F.col("valid_from")))
        & (F.col("valid_to").isNull() | (F.col("ts") < F.col("valid_to"))))
    return changes.join(config, held).drop("_table", "_type", "valid_from", "valid_to")


def prune_columns(routed: DataFrame) -> DataFrame:
    """Keep only the configured columns of each record's data."""
    return routed.withColumn("data", keep_keys("data", "sink_columns"))


def route(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Cleaned changes with their sink: (sink_type, sink_table, sink_pk, data, ...)."""
    routed = prune_columns(match_routes(changes, routes))
    return routed.filter(F.col("sink_type").isin(FACT_SINK, DIM_SINK)).withColumn(
        "sink_pk", F.coalesce("sink_pk", F.lit(DEFAULT_PK))
    )


def facts(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sink_type") == FACT_SINK)


def dims(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sink_type") == DIM_SINK)
