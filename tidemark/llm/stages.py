"""Stages of the corpus pipeline (see ``corpus_pipeline``).

Each takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``docs``.  Rows keep what their operator's docstring says of
nulls, repeats and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language_id, mixing, simhash, substring_dedup
from tidemark.llm.common import learnable, table


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` brought in line with ``text``."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else docs


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts that get no language (null, or no letters) go."""
    return language_id.accept(docs, language_id.train(docs.where(learnable())))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each component stays."""
    return simhash.deduplicate(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: repeated 20-word windows stay where they start first."""
    return _counted(substring_dedup.clean(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark phrase go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: what the mix takes, with ``mix_copies`` and ``mix_words``."""
    return mixing.draw(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_dedup", one_of_each),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]
