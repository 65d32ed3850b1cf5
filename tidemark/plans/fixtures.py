"""Inputs of the registered queries, derived by Spark from the given tables.

Each loader has a DuckDB twin in ``sqlparts`` so the oracle computes from the
same raw tables (never from our output).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import DAILY, HOURLY, MINUTE
from tidemark.sources.bars import events_bars, lineitem_bars, orders_bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Bars feed several branches of every plan (row numbering reads them twice,
# composites more often); they are persisted (memory, spilling to disk; a lost
# block is recomputed from lineage) so the raw ticks are scanned and
# aggregated once per query instead of once per branch.


def shared(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(events_bars(table(spark, sf_dir, "events"), "hour"))


def bars_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(events_bars(table(spark, sf_dir, "events"), "minute"))


def bars_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(orders_bars(table(spark, sf_dir, "orders")))


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(lineitem_bars(table(spark, sf_dir, "lineitem")))


LAYOUTS = {"hourly": HOURLY, "minute": MINUTE, "daily": DAILY}


def with_nulls(bars: DataFrame, column: str = "close", every: int = 7, first: int = 3) -> DataFrame:
    """Edge fixture: null out ``column`` where (row position % every) < first.

    Position = rank of bar_ts inside the series; used to exercise fill,
    interpolation and missing-value reports on tables that hold no nulls.
    """
    from tidemark.operators.ordered import POS, with_position
    p = with_position(bars, HOURLY)
    return p.withColumn(column, F.when(F.pmod(F.col(POS), F.lit(every)) < first, F.lit(None))
                        .otherwise(F.col(column))).drop(POS)


def with_null_keys(bars: DataFrame) -> DataFrame:
    """Edge fixture: one series without a name, and no time stamp on the last
    bar of each series."""
    last = bars.groupBy("series").agg(F.max("bar_ts").alias("_last"))
    known = bars.join(last, "series")
    return known.select(F.expr("nullif(series, 'click')").alias("series"),
                        F.when(F.col("bar_ts") < F.col("_last"), F.col("bar_ts")).alias("bar_ts"),
                        *[c for c in bars.columns if c not in ("series", "bar_ts")])
