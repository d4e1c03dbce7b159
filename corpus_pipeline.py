"""From raw documents to a training mix: five stages, each on all that the one before it kept.

Quality: documents that the classifier rejects go. Near-duplicates: of each group of like fingerprints one
document stays. Suffix dedup: repeated 200-byte passages go from the texts. Decontamination: documents in which
a benchmark item is found go. Mixing: the documents that are left, drawn to their sources' targets; a row for
each draw, with its output shard and its place there. All but the last return the columns of documents.

A null text is empty to every stage: it is scored like any other, is near to other empty ones, has no passage and
isn't drawn. Rows with a null id are rows of their own. Of rows that repeat in all columns one stays. Of near
duplicates the least id stays, so ties don't arise. Very long texts go through whole. Other columns pass through all
stages, whatever their names, but for the four that mixing adds. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioloom.llm import decontaminate, mixing, quality, simhash, suffix_dedup
from folioloom.llm.common import table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [("quality", good_documents), ("near_duplicates", one_of_each_group), ("suffix_dedup", without_repeated_passages), ("decontamination", without_benchmark), ("mixing", mixed)]

#: Trained scores and fingerprints of XXH64 bits are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
