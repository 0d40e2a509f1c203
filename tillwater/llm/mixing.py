"""Mixing sources to target weights, by budgets handed down a tree.

The tree has three levels (domain, language, source). A node's budget is shared among
its children by weight; a child that holds too little (its tokens times MAX_EPOCHS) is
filled and its shortage goes to its siblings, and only what a whole subtree lacks goes
to the siblings of its parent. A leaf takes whole epochs of its documents, then, in the
order that the seed and the epoch's number give, the longest prefix that fits into the
rest of its budget. Everything is a DataFrame expression.

The place where a prefix ends is found by narrowing: tokens are summed by the next two
digits of the order key, within the digits that the end is known to share, until few
documents are left. So no leaf is sorted as a whole, and the documents themselves are
never shuffled: a row is taken if its key does not exceed its leaf's last key.

Defined cases: null texts have no tokens, null levels are the empty name; rows that
share a doc_id share a key and are taken together (a null id is the empty text); a
document without tokens is taken only with whole epochs; a node without weight gets nothing; if
all leaves together hold too little, each is taken MAX_EPOCHS times; an empty table
gives no rows; columns of the input that are named like a result column are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwater.llm.common import cut

LEVELS = ("domain", "language", "origin")
BUDGET_SHARE = 0.5
MAX_EPOCHS = 2
SEED = "tillwater"
DIGITS = 2
#: Narrowing ends when a leaf of evenly spread keys has about this many documents left.
FEW_DOCUMENTS = 1_000

# Target weights of the given tables. They have no domains, so the number in a source's
# name stands for one.
DOMAINS = {0: "web", 1: "books", 2: "forums"}
WEIGHTS = {
    "domain": {"web": 0.5, "books": 0.3, "forums": 0.2},
    "language": {"en": 0.55, "de": 0.2, "fr": 0.15, "es": 0.1},
    "origin": {},
}
OTHER_WEIGHT = {"domain": 0.1, "language": 0.05, "origin": 1.0}


def domain_of(source: Column) -> Column:
    number = F.coalesce(
        F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
        .try_cast("bigint"), F.lit(0))
    domain = F.lit(DOMAINS[0])
    for rest, name in DOMAINS.items():
        domain = F.when(number % len(DOMAINS) == rest, name).otherwise(domain)
    return domain


def weight_of(level: str, weights: dict[str, dict[str, float]]) -> Column:
    weight = F.lit(OTHER_WEIGHT[level])
    for name, value in weights[level].items():
        weight = F.when(F.col(level) == name, F.lit(float(value))).otherwise(weight)
    return weight


def shared(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds `given`: the parent's `budget` shared by `weight`, at most `capacity` each."""
    family = Window.partitionBy(*(parents or [F.lit(0)]))
    order = family.orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(
        F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    waiting = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    # A child is full if even an equal share of what the fuller ones leave exceeds it.
    full = F.col("capacity") * waiting <= F.col("weight") * (F.col("budget") - before)
    marked = children.where("weight > 0").withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(family), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    rest = (F.col("budget") - taken) * F.col("weight") / open_weight
    return marked.withColumn(
        "given", F.when(F.col("full"), F.col("capacity")).otherwise(F.greatest(rest, F.lit(0.0))))


def leaf_budgets(
    leaves: DataFrame, budget: float, max_epochs: int, weights: dict[str, dict[str, float]],
) -> DataFrame:
    """Tokens for each leaf (domain, language, origin, tokens)."""
    held = leaves.select(*LEVELS, "tokens", (F.col("tokens") * max_epochs).cast("double")
                         .alias("capacity"))
    given = None
    for depth, level in enumerate(LEVELS, start=1):
        nodes = held.groupBy(*LEVELS[:depth]).agg(
            F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", weight_of(level, weights))
        parents = list(LEVELS[: depth - 1])
        if given is None:
            nodes = nodes.withColumn("budget", F.lit(float(budget)))
        else:
            nodes = nodes.join(
                given.select(*parents, F.col("given").alias("budget")), parents)
        given = shared(nodes, parents, level)
    return given.select(*LEVELS, "tokens", F.floor(F.round("given", 3)).alias("budget"))


def mix(
    docs: DataFrame, domain: Column, budget_share: float = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS, seed: str = SEED, few: int = FEW_DOCUMENTS,
    weights: dict[str, dict[str, float]] = WEIGHTS,
) -> DataFrame:
    """The rows of `docs` with domain, n_tokens and n_copies, the times each is taken."""
    columns = [c for c in docs.columns if c.lower() not in ("domain", "n_tokens", "n_copies")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = docs.select(
        F.struct(*columns).alias("row"),
        domain.alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("origin"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
    )
    narrow = cut(placed.drop("row"), "mixing-tokens")
    leaves = cut(
        narrow.groupBy(*LEVELS).agg(
            F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")),
        "mixing-leaves")
    sums = leaves.agg(F.sum("tokens").alias("tokens"), F.max("documents").alias("most")).first()
    total, most = sums["tokens"] or 0, sums["most"] or 0
    budgets = leaf_budgets(leaves, total * budget_share, max_epochs, weights)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0)
    state = cut(
        budgets.withColumn("epochs", whole.cast("long")).select(
            *LEVELS, "epochs", (F.col("budget") - F.col("epochs") * F.col("tokens"))
            .cast("long").alias("rest"), F.lit("").alias("digits")),
        "mixing-budgets")
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("epochs").cast("string"), F.col("id"))
                .cast("binary"))
    keyed = cut(
        narrow.join(state.select(*LEVELS, "epochs"), list(LEVELS)).select(
            *LEVELS, "n_tokens", key.alias("key")),
        "mixing-keys")
    by_leaf = Window.partitionBy(*LEVELS)
    known = 0
    while most > few and known < 16:
        next_digits = F.substring("key", known + 1, DIGITS)
        parts = keyed.join(state, list(LEVELS)).where(F.col("key").startswith(F.col("digits")))
        parts = parts.groupBy(*LEVELS, "epochs", "rest", "digits", next_digits.alias("next")).agg(
            F.sum("n_tokens").alias("tokens"))
        so_far = F.sum("tokens").over(by_leaf.orderBy("next"))
        state = cut(
            parts.withColumn("so_far", so_far).where("so_far > rest")
            .withColumn("place", F.row_number().over(by_leaf.orderBy("next")))
            .where("place = 1").select(
                *LEVELS, "epochs", (F.col("rest") - F.col("so_far") + F.col("tokens"))
                .alias("rest"), F.concat("digits", "next").alias("digits")),
            "mixing-narrowed")
        known += DIGITS
        most /= 16**DIGITS
    # The few documents that share the digits decide the last key taken.
    final = keyed.join(state, list(LEVELS)).where(F.col("key").startswith(F.col("digits")))
    taken = final.withColumn("so_far", F.sum("n_tokens").over(by_leaf.orderBy("key"))).where(
        "so_far <= rest")
    last = taken.groupBy(*LEVELS).agg(F.max("key").alias("last"))
    ends = cut(
        state.join(last, list(LEVELS), "left").select(
            *LEVELS, F.col("epochs").alias("epochs"),
            F.coalesce("last", "digits").alias("last")),
        "mixing-ends")
    in_prefix = (key <= F.col("last")) & (F.col("n_tokens") > 0)
    copies = F.col("epochs") + F.when(in_prefix, 1).otherwise(0)
    return placed.join(ends, list(LEVELS), "left").select(
        *[F.col("row")[c].alias(c) for c in columns], "domain", "n_tokens",
        F.coalesce(copies, F.lit(0)).cast("long").alias("n_copies"))
