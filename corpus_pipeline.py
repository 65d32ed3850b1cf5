"""Corpus pipeline: the documents that a training run would read.

``STAGES`` are applied in order.  Each stage works on everything that the one
before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm.common import table, written

STAGES = stages.STAGES

#: Language models, fingerprints and byte models have no SQL form; the stages
#: are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the columns of ``documents``, ``mix_copies`` and
    ``mix_words``.

    Documents without text or letters go in the first stage.  Rows that repeat an
    id and a text, and near copies, are one document from the second stage on; rows
    that share only the id are different documents; a null id is an id of its own,
    before all others.  Texts that lose words are joined by single spaces, with
    ``n_chars`` brought in line.  Other columns, of any name, stay as they are.  An
    empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '_')}")
    return docs
