"""Registry of named queries: Spark plan + DuckDB oracle twin.

``register(name, sql)`` decorates a ``(spark, sf_dir) -> DataFrame`` function.
Every registered plan ends in ``finish``: double columns rounded to 6 places
(the oracle rounds the same columns), so a cross-engine value hash does not
depend on float summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType

from tidemark.functions.exprs import clean_double

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
DOUBLES: dict[str, list[str]] = {}


def register(name: str, sql: str | None = None, doubles: list[str] | None = None):
    """Register a query; ``sql`` (core, unrounded) and ``doubles`` (columns
    to round) build the oracle; ``sql=None`` means rows-only checking."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            from tidemark.plans.sqlparts import rounded
            ORACLE[name] = rounded(sql, doubles or [])
            DOUBLES[name] = list(doubles or [])
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Round every double column (see module doc)."""
    fix = {f.name: clean_double(f.name) for f in df.schema.fields
           if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(fix) if fix else df


def load_all() -> None:
    """Import every query module so that all queries are registered."""
    from tidemark.plans import (q_eval, q_forecast, q_indicators, q_ml,  # noqa: F401
                                q_quality, q_relations, q_sources, q_stream)
