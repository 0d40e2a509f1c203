"""The text functions for use in SQL, as built-in expressions under a name.

Those that return arrays are computed as a column and then unpacked with
`LATERAL VIEW explode(...)` or `LATERAL VIEW inline(...)`, which stay generators
in the plan. The table functions are called as `t, LATERAL f(...)` or as `t JOIN
LATERAL f(...) ON true`; Spark computes them once for each distinct argument and
joins the table to that, so they cost a shuffle and pay where arguments repeat.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillwater.functions.text import OTHER_WEIGHT, SOURCE_WEIGHTS

_WEIGHTS = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in SOURCE_WEIGHTS.items())

SQL_FUNCTIONS = {
    "split_words(txt STRING) RETURNS ARRAY<STRING>": r"""
        array_distinct(filter(split(lower(txt), '[^\\p{L}\\p{N}]+'), w -> w <> ''))""",
    "positive_sources(click BIGINT, cart BIGINT, orders BIGINT) "
    "RETURNS ARRAY<STRUCT<source STRING, ct BIGINT>>": """
        filter(array(
            named_struct('source', 'click', 'ct', coalesce(click, 0L)),
            named_struct('source', 'cart', 'ct', coalesce(cart, 0L)),
            named_struct('source', 'order', 'ct', coalesce(orders, 0L))
        ), p -> p.ct > 0)""",
    "source_weight(source STRING) RETURNS INT": f"CASE source {_WEIGHTS} ELSE {OTHER_WEIGHT} END",
}

TABLE_FUNCTIONS = {
    "words_of(txt STRING) RETURNS TABLE(word STRING)": r"""
        SELECT explode(array_distinct(filter(
            split(lower(txt), '[^\\p{L}\\p{N}]+'), w -> w <> ''))) AS word""",
    "product_sources(click BIGINT, cart BIGINT, orders BIGINT) "
    "RETURNS TABLE(source STRING, ct BIGINT)": """
        SELECT p.source, p.ct FROM (SELECT explode(array(
            named_struct('source', 'click', 'ct', click),
            named_struct('source', 'cart', 'ct', cart),
            named_struct('source', 'order', 'ct', orders))) AS p)
        WHERE p.ct > 0""",
}


def register(spark: SparkSession) -> None:
    """Make the functions known to `spark.sql`, for this session."""
    for signature, body in {**SQL_FUNCTIONS, **TABLE_FUNCTIONS}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
