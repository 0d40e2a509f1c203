"""Benchmark decontamination by spaced seeds.

A mask names SEED_WORDS of a few neighbouring word places and ignores the others. The
hashes of the named words of every benchmark place are joined with those of every
document place; a hit fixes how document and item lie upon each other (the diagonal).
Along it, words that agree count 1 and words that were substituted count
-SUBSTITUTION; the best stretch must reach `needed` for the document to be contaminated.
Everything is a DataFrame expression.

Benchmark tables of up to MOST_BROADCAST words are broadcast; document words then stream
through two hash joins without a shuffle, the first of which drops places whose first
word no item has. Larger benchmarks are joined by shuffled seeds, with equal results.
Only documents with a hit are looked at again, to verify along the diagonals; the others'
texts are not shuffled.

Defined cases: null texts are empty; texts and items of fewer than SEED_WORDS words have
no seeds and no hits, and items of fewer than LEAST_SCORE words cannot reach that score, so
neither are reported; repeated rows with one doc_id count as one document that has the
words of each; repeated item rows likewise; rows with a null id are left out; further
columns are never read; an empty benchmark finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwater.llm.common import cut

# Word places that each mask looks at.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 6, 7), (0, 2, 3, 6, 7, 9))
SEED_WORDS = 6
SUBSTITUTION = 2
#: A stretch counts from this score, or from this share of an item's words if that is less,
#: and never below LEAST_SCORE.
FULL_SCORE, SHARE, LEAST_SCORE = 12, 0.6, 8
MOST_BROADCAST = 2_000_000
CHUNK_WORDS = 128
PARTS_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Lower-cased words; only the first and the last can be empty."""
    return F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), PARTS_WORDS)


def seed(words: Column, place: Column, mask: tuple[int, ...]) -> Column:
    """Hash of the words that the mask names from `place`; null if one is missing."""
    named = [F.get(words, place + o if o else place) for o in mask]
    # Places only grow, so the last word is missing if any is.
    return F.when(named[-1].isNotNull(), F.xxhash64(*named))


def needed(length: Column) -> Column:
    return F.greatest(
        F.lit(LEAST_SCORE), F.least(F.lit(FULL_SCORE), F.ceil(length * SHARE))).cast("int")


def best_stretch(words: Column, item: Column, diagonal: Column) -> Column:
    """Highest sum over neighbouring places of 1 for equal and -SUBSTITUTION for other words."""
    low = F.greatest(F.lit(0), diagonal)
    length = F.least(F.size(words), diagonal + F.size(item)) - low
    equal = F.zip_with(
        F.slice(words, low + 1, length), F.slice(item, low - diagonal + 1, length),
        lambda a, b: a == b)
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(state: Column, same: Column) -> Column:
        now = F.greatest(F.lit(0), state["now"] + F.when(same, 1).otherwise(-SUBSTITUTION))
        return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"))

    return F.aggregate(equal, zero, step, lambda s: s["best"])


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id and its words."""
    words = F.filter(words_of("text"), lambda w: w != "")
    return benchmark.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), words.alias("item_words")).where(
        F.size("item_words") >= SEED_WORDS)


def seeds_of(items: DataFrame) -> DataFrame:
    """(mask, seed, item_id, item_place) of every place of every item."""
    placed = items.select("item_id", "item_words", F.posexplode("item_words").alias("at", "word"))
    each = F.array(*[seed(F.col("item_words"), F.col("at"), m) for m in MASKS])
    return placed.select(
        "item_id", F.col("at").alias("item_place"), F.posexplode(each).alias("mask", "seed")
    ).where("seed IS NOT NULL")


def chunks_of(docs: DataFrame) -> DataFrame:
    """(doc_id, start, chunk): CHUNK_WORDS words and the few more that a mask reaches over.

    A place then carries a short list along, however long its document is.
    """
    reach = max(m[-1] for m in MASKS)
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(CHUNK_WORDS))
    chunks = F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.slice("words", s + 1, CHUNK_WORDS + reach).alias("chunk")))
    return docs.select("doc_id", F.inline(chunks))


def hits_by_broadcast(docs: DataFrame, items: DataFrame, seeds: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, diagonal), joined as the words stream by."""
    first_words = items.select(F.explode("item_words").alias("word")).distinct()
    places = chunks_of(docs).select(
        "doc_id", "start", "chunk", F.posexplode("chunk").alias("at", "word"))
    places = places.where(F.col("at") < CHUNK_WORDS).join(
        F.broadcast(first_words), "word", "left_semi")
    each = F.array(*[seed(F.col("chunk"), F.col("at"), m) for m in MASKS])
    seeded = places.select(
        "doc_id", (F.col("start") + F.col("at")).alias("place"),
        F.posexplode(each).alias("mask", "seed"))
    return seeded.where("seed IS NOT NULL").join(F.broadcast(seeds), ["mask", "seed"]).select(
        "doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("diagonal"))


def hits_by_shuffle(docs: DataFrame, items: DataFrame, seeds: DataFrame) -> DataFrame:
    """The same rows, joined by shuffled seeds."""
    places = F.sequence(F.lit(0), F.least(F.size("chunk"), F.lit(CHUNK_WORDS)) - 1)

    def under(number: int, mask: tuple[int, ...]) -> Column:
        return F.transform(places, lambda i: F.struct(
            F.lit(number).alias("mask"), i.alias("at"),
            seed(F.col("chunk"), i, mask).alias("seed")))

    every = F.flatten(F.array(*[under(number, mask) for number, mask in enumerate(MASKS)]))
    seeded = chunks_of(docs).select("doc_id", "start", F.inline(every))
    return seeded.where("seed IS NOT NULL").join(seeds, ["mask", "seed"]).select(
        "doc_id", "item_id",
        (F.col("start") + F.col("at") - F.col("item_place")).alias("diagonal"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """(doc_id, item_id, score, n_item_words) of each document and item that overlap."""
    items = cut(items_of(benchmark), "decontamination-items")
    n_words = items.agg(F.sum(F.size("item_words")).alias("n")).first()["n"] or 0
    seeds = seeds_of(items)
    named = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    worded = named.select("doc_id", words_of("text").alias("words"))
    join = hits_by_broadcast if n_words <= most_broadcast else hits_by_shuffle
    hits = cut(join(worded, items, seeds).distinct(), "decontamination-hits")
    size = F.size("item_words")
    # Only texts with a hit are looked at again: few ids, which Spark broadcasts by their size.
    # The text is joined, not its words, which take more than twice the bytes.
    marked = cut(hits.select("doc_id").distinct(), "decontamination-marked")
    suspects = named.join(marked, "doc_id", "left_semi")
    again = suspects.join(hits.join(items, "item_id"), "doc_id").withColumn(
        "words", words_of("text"))
    scored = again.select(
        "doc_id", "item_id", size.alias("n_item_words"),
        best_stretch(F.col("words"), F.col("item_words"), F.col("diagonal")).alias("score"))
    return scored.where(F.col("score") >= needed(F.col("n_item_words"))).groupBy(
        "doc_id", "item_id").agg(
        F.max("score").alias("score"), F.max("n_item_words").alias("n_item_words"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that overlap with no item; rows with a null doc_id stay."""
    found = cut(contaminated(docs, benchmark).select("doc_id").distinct(), "decontamination-found")
    return docs.join(found, docs["doc_id"].cast("long") == found["doc_id"], "left_anti")
