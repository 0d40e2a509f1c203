"""Starting, draining and watching streaming queries."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tillwater.session import STATE_SETTINGS, UNCOUNTED, UNSETTLED, scratch_dir
from tillwater.sinks.tables import batch_folder

TRIGGER = "3 seconds"


def start(
    spark: SparkSession, writer: DataStreamWriter, checkpoint: str,
    name: str | None = None, trigger: str = TRIGGER, drain: bool = False,
    state_partitions: int | None = None, count_state: bool = True, settle: bool = True,
) -> StreamingQuery:
    """Start a sink's writer.

    The checkpoint must lie where all executors reach it; a restart from it
    goes on where the query stopped. `drain` processes what is there and stops.
    `state_partitions` fixes the number of state partitions, which a query
    keeps for as long as its checkpoint lives; choose it for the final size.
    `count_state` reports the number of state rows, at the cost of a read for each write.
    Without `settle` state that the last input made old stays until there is more input,
    which changes nothing for inner joins; windows would stay open.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=trigger)
    settings = {
        **STATE_SETTINGS, **({} if count_state else UNCOUNTED), **({} if settle else UNSETTLED)}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        return writer.start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_stage(
    spark: SparkSession, stage, sources: dict[str, DataFrame], sinks: dict,
    checkpoint: str, **options,
) -> dict[str, StreamingQuery]:
    """Run `stage(**sources)`, a dict of named outputs, each into its sink.

    A sink is a function from a DataFrame to a stream writer. Every output is a
    query of its own, with its own checkpoint below the given one.
    """
    outputs = stage(**sources)
    unknown = set(sinks) - set(outputs)
    if unknown:
        raise ValueError(f"no such outputs: {sorted(unknown)}")
    return {
        name: start(spark, sink(outputs[name]), f"{checkpoint}/{name}", **options)
        for name, sink in sinks.items()
    }


def drain_to_folder(
    spark: SparkSession, df: DataFrame, purpose: str, state_partitions: int | None = None,
    **options,
) -> str:
    """Run a stream over all present input into a scratch table; its folder."""
    base = scratch_dir(spark, purpose)
    writer = df.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
    query = start(
        spark, writer, f"{base}/checkpoint", drain=True,
        state_partitions=state_partitions or spark.sparkContext.defaultParallelism,
        **{"count_state": False, **options},
    )
    query.awaitTermination()
    return f"{base}/out"


def stopped_at(spark: SparkSession, checkpoint: str) -> tuple[list[str], int]:
    """Where a stopped query's sources stood after its last committed batch, and the watermark.

    An offset is the text that the source itself wrote; a topic's goes into the option
    `startingOffsets` of a query that goes on from another's state.
    """
    files = spark.read.text(f"{checkpoint}/commits").select(F.col("_metadata.file_name")).distinct()
    last = files.agg(F.max(F.col("file_name").cast("long"))).first()[0]
    # One small text file: a version, the watermark and settings, a line for each source.
    lines = spark.read.text(f"{checkpoint}/offsets/{last}", wholetext=True).first()[0].split("\n")
    return [x for x in lines[2:] if x], json.loads(lines[1])["batchWatermarkMs"]


class LateRows(StreamingQueryListener):
    """Counts the rows that each query dropped for coming after its watermark.

    Add one with `spark.streams.addListener` before the queries start. It sums
    over all progress reports; a query itself only keeps its last ones. Spark
    counts rows as they reach the state, which is after partial aggregation, so
    several late records of one group and task can count as one.
    """

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped[str(event.progress.id)] += sum(
            op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def count(self, query: StreamingQuery) -> int:
        return self.dropped[str(query.id)]


def start_split(
    spark: SparkSession, df: DataFrame, split: Callable[[DataFrame], dict[str, DataFrame]],
    path: str, checkpoint: str, **options,
) -> StreamingQuery:
    """One query with several outputs: each batch is kept, split and written to folders.

    The source is read, and any state kept, once for all outputs, and they always
    agree on where the stream stands. `split` takes a batch and returns named
    frames; each goes to `{path}/{name}`, into a folder of the batch's own that a
    retry overwrites. A name without rows gets its columns all the same.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for name, out in split(kept).items():
                out.write.mode("overwrite").parquet(
                    f"{path}/{name}/{batch_folder(batch, batch_id)}")
        finally:
            kept.unpersist()

    return start(spark, df.writeStream.foreachBatch(write), checkpoint, **options)
