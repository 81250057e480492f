"""A corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns rows of the columns of
documents, but for the last, which returns the shard of each row. run() writes each stage's result as Parquet in the
shared folder and reads it again.

Defined results of every stage: null ids are ids like any other, a null or empty text has no words and so goes in the first
stage; an empty table stays empty; columns of any other name pass through. Repeated rows (equal in id and text) are one
document from the second stage on, of which any one stays; rows of one id and different texts are different documents. Of
a group of near copies the row of the smallest id stays (null last), of equal ids the one of the smallest text hash.
Without labels nothing but the base rules rejects, without a benchmark nothing is contaminated. The mix repeats rows on
purpose, and the last stage gives one row for each repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparquill.llm import decontaminate, mixing, near_copies, quality_rules, sharding
from sparquill.llm.common import read_table, stage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learnt list reject go; the list is the one that op1 learns."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle similarity 0.8 or more stays, that of the smallest id. It is op9's
    search by fingerprints, pigeonhole dealing and Gray-order index over five-word shingles, as near_copies says."""
    return near_copies.drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in the order of the mix."""
    return mixing.take(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each row."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", clean),
    ("mixing", mixed),
    ("sharding", shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
