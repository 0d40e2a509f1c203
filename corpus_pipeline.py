"""A training corpus from raw documents, stage by stage.

Every stage reads all that its predecessor kept. Documents go for toxicity, as near copies
of another document, or for overlap with a benchmark; repeated passages are cut from the
texts that stay; the last stage says how often each document is taken for the mixture.

A decision names a row by its doc_id and a 64-bit hash of its text, so a clean row that
shares an id with a rejected one stays. Documents without an id cannot be named by a
decision: no stage drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwater.llm import decontamination, mixing, repeats, simhash, toxicity
from tillwater.llm.common import cut, documents, text_key


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` but the rows with an id whose (doc_id, text) is in `gone` (gone, gone_key)."""
    return docs.join(
        gone, (docs["doc_id"].cast("long") == gone["gone"]) & (text_key() == gone["gone_key"]),
        "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects go."""
    scores = toxicity.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, cut(
        scores.where("predicted = 1 AND doc_id IS NOT NULL").select(
            F.col("doc_id").alias("gone"), F.col("text_key").alias("gone_key")).distinct(),
        "pipeline-toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays, once.

    Texts are the operator's documents here, by their hash, so that rows that share an
    id do not link their texts.
    """
    named = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"), text_key().alias("doc_id"), "text")
    groups = cut(
        simhash.near_duplicates(named).select(
            F.col("doc_id").alias("key"), "component_id").distinct(),
        "pipeline-groups")
    rows = cut(
        named.select("id", F.col("doc_id").alias("key")).join(groups, "key"), "pipeline-near")
    # Written first, so that the join can split the rows of a large group.
    stays = cut(
        rows.groupBy("component_id").agg(F.min(F.struct("id", "key")).alias("stays")),
        "pipeline-stays")
    kept = without(docs, cut(
        rows.join(stays, "component_id").where("id <> stays.id OR key <> stays.key").select(
            F.col("id").alias("gone"), F.col("key").alias("gone_key")).distinct(),
        "pipeline-copies"))
    if rows.groupBy("id", "key").count().where("count > 1").limit(1).count():
        # Of rows with one id and text the first by all their columns stays.
        order = Window.partitionBy("doc_id", text_key()).orderBy(F.to_json(F.struct("*")))
        kept = kept.where("doc_id IS NOT NULL").withColumn(
            "_pipeline_turn", F.row_number().over(order)).where("_pipeline_turn = 1").drop(
            "_pipeline_turn").unionByName(kept.where("doc_id IS NULL"))
    return kept


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that occur earlier are cut from the texts."""
    return repeats.shortened(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go; the overlap is the text's alone."""
    found = decontamination.contaminated(
        docs.where("doc_id IS NOT NULL").select(text_key().alias("doc_id"), "text"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = cut(found.select(F.col("doc_id").alias("gone_key")).distinct(), "pipeline-leaks")
    return docs.join(
        gone, docs["doc_id"].isNotNull() & (text_key() == gone["gone_key"]), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, with the number of times."""
    return mixing.mix(docs, mixing.domain_of(F.col("source"))).where("n_copies > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]
# Trained scores, components of links and byte spans are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read back."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
