"""A corpus pipeline: filter, remove near-copies and repeated passages, pack for training.

Each stage takes all documents its predecessor kept and is written before the next one reads.

Defined cases: documents with null or empty texts fail the quality rules and go; rows that repeat in
all columns stay once, as near copies of each other, and so do rows that share an id and differ
elsewhere if that id names its group; rows with a null id stay only if nothing like them has one; an
empty table gives no pieces; other columns are carried along up to packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfit.llm import ngram_join, quality_rules, suffix_dedup, toxicity
from starfit.llm.queries import packed
from starfit.llm.tables import staged
from starfit.session import with_local_folder

#: Packing and scores are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def pass_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the compression bands."""
    return quality_rules.accepted(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted to be toxic by a model trained on the labelled ones among them."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones."""
    with_local_folder(spark)
    return ngram_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller ids hold, too."""
    with_local_folder(spark)
    left = suffix_dedup.without_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    with_local_folder(spark)
    return packed(docs)


STAGES = [
    ("quality rules", pass_quality_rules),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_local_folder(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
