"""A corpus pipeline of the training-data operators; ``run`` applies the stages to ``documents``.

Every stage but the last returns the columns of ``documents``; the last returns the mix:
one row per document left, with the words that the mix takes of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, dedup, language, mixing, quality
from tidemark.llm.common import staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; texts without letters or with no language of half their letters go."""
    return language.keep_identified(docs, language.fit(docs.filter(~language.held_out())))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality.fit(docs.filter(~quality.held_out()), table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    return decontam.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of every document so that the sources meet their targets."""
    return mixing.mix(docs)


STAGES = [("language ID", identify_language), ("quality classifier", keep_quality), ("MinHash near-dedup", deduplicate),
          ("benchmark decontamination", decontaminate), ("mixing sources", mix)]
# two stages are learned models: tested against the same steps applied one by one instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage{i}")
    return docs
