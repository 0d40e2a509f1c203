"""The keyed state of a stopped query as a table, and rows kept in state by the chunk."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F


class Chunks:
    """Rows in a list state, thousands to an element, since each element and call costs.

    A row is a tuple of texts, whole numbers and nulls. Rows come back as lists.
    """

    SCHEMA = "rows string"
    # Keeps an element and a message to the state to some megabytes.
    ROWS, ELEMENTS = 2_000, 16

    def __init__(self, state):
        self._state = state

    def get(self) -> list[list]:
        return self.read()[0]

    def read(self) -> tuple[list[list], int]:
        """The rows, in the order in which they were added, and the number of elements."""
        if not self._state.exists():
            return [], 0
        elements = [element[0] for element in self._state.get()]
        return [row for element in elements for row in json.loads(element)], len(elements)

    def add(self, rows: list[tuple]) -> None:
        elements = [
            (json.dumps(rows[i:i + self.ROWS], ensure_ascii=False, separators=(",", ":")),)
            for i in range(0, len(rows), self.ROWS)]
        for i in range(0, len(elements), self.ELEMENTS):
            self._state.appendList(elements[i:i + self.ELEMENTS])

    def put(self, rows: list[tuple]) -> None:
        """These rows instead of all before."""
        self._state.clear()
        self.add(rows)


def has_variable(spark: SparkSession, checkpoint: str, name: str) -> bool:
    """Whether exactly one operator of the checkpoint has a state variable of that name."""
    return len(_operators(spark, checkpoint, name)) == 1


def _operators(spark: SparkSession, checkpoint: str, name: str) -> list:
    # Reading state needs the service that keeps track of it; the manager starts it.
    _ = spark.streams.active
    holds = F.get_json_object("operatorProperties", "$.stateVariables[*].stateName")
    return spark.read.format("state-metadata").load(checkpoint).filter(
        holds.contains(f'"{name}"')).select("operatorId").distinct().collect()


def state_variable(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """The keys and values of the one state variable of that name in a checkpoint.

    Lists come as a row for each element. It is the state after the last committed batch.
    """
    operators = _operators(spark, checkpoint, name)
    if len(operators) != 1:
        raise ValueError(f"{len(operators)} operators with a state {name!r} in {checkpoint}")
    return spark.read.format("statestore").option("path", checkpoint).option(
        "operatorId", operators[0]["operatorId"]).option("stateVarName", name).option(
        "flattenCollectionTypes", "true").load()


def chunk_rows(spark: SparkSession, checkpoint: str, name: str, *fields: str) -> DataFrame:
    """The rows of a variable of `Chunks`; each field is a name and a type."""
    elements = state_variable(spark, checkpoint, name).select(
        F.explode(F.from_json("list_element.rows", "array<array<string>>")).alias("r"))
    named = [field.split() for field in fields]
    return elements.select(
        *[F.col("r")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(named)])
