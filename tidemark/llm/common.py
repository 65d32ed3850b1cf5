"""Helpers shared by the operators: table access, written tables, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.session import shared_dir

#: Rows without an id sort before every other row; this value stands for them in join keys.
NO_ID = -(2 ** 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared folder and read it
    back: later jobs survive lost executors and never compute it again."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch, where the session has Spark's default (10,000): texts
#: may be long, and a batch is held by the JVM and by the Python worker.
ARROW_ROWS = 1_000


def arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of ``ARROW_ROWS``."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, str(ARROW_ROWS))
    return df.mapInArrow(run, schema)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the third of the rows that no label is learned from.  A null
    id is in no fold: it is neither learned from nor held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 3 == 1, F.lit(False))


def learnable(doc_id: str | Column = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 3 != 1, F.lit(False))


def document_key(docs: DataFrame) -> Column:
    """A row's id for joins, a long that is never null: a whole number itself, an
    id of another type its hash (documents then follow each other in its order)."""
    c, kind = F.col("doc_id"), docs.schema["doc_id"].dataType
    number = c.cast("long") if isinstance(kind, IntegralType) else F.when(c.isNotNull(), F.xxhash64(c.cast("string")))
    return F.coalesce(number, F.lit(NO_ID))


def spare(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``docs`` has, one for each of ``names``."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` plus the join key of a document: ``_d`` (its id, or
    ``NO_ID``) and ``_h`` (hash of its text).  Rows that agree in both are one
    document; rows that share an id but not the text are different ones."""
    return docs.select("doc_id", "text").withColumns({"_d": document_key(docs), "_h": F.xxhash64("text")})
