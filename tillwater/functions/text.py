"""Text, map and branching columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillwater.functions.times import _col

# Weight of a keyword by where it was seen.
SOURCE_WEIGHTS = {"search": 2, "click": 4, "cart": 6}
OTHER_WEIGHT = 8


def is_blank(c) -> Column:
    """Null or empty."""
    return F.coalesce(_col(c), F.lit("")) == ""


def tokenize(c) -> Column:
    """Distinct lower-cased runs of letters and digits of the whole text."""
    words = F.split(F.lower(_col(c)), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def positive_sources(click, cart, order) -> Column:
    """Array of (source, ct), one element per positive measure."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("source"), F.coalesce(_col(c), F.lit(0)).cast("long").alias("ct"))
            for name, c in (("click", click), ("cart", cart), ("order", order))
        ]
    )
    return F.filter(pairs, lambda p: p["ct"] > 0)


def any_positive(*cols) -> Column:
    """True when at least one measure is above zero."""
    return F.greatest(F.lit(0), *[_col(c) for c in cols]) > 0


def source_weight(c) -> Column:
    weight = F.lit(OTHER_WEIGHT)
    for name, value in SOURCE_WEIGHTS.items():
        weight = F.when(_col(c) == name, F.lit(value)).otherwise(weight)
    return weight


def keep_keys(data, columns) -> Column:
    """Map entries whose key is in a comma-separated list (no trimming)."""
    wanted = F.split(_col(columns), ",")
    return F.map_filter(_col(data), lambda k, _: F.array_contains(wanted, k))


def upper_keys(data) -> Column:
    return F.transform_keys(_col(data), lambda k, _: F.upper(k))


def drop_bootstrap(c) -> Column:
    """`bootstrap-insert` and the like as the plain operation."""
    return F.regexp_replace(_col(c), "bootstrap-", "")
