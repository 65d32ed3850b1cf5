"""Mergeable quantile sketches: profiles of a large table from small states.

A KLL sketch (Spark's own aggregate, a few kB) is kept as binary for each group,
column and day, with the moments; days merge into any longer span without reading
a row again.  A quantile's rank is off by at most ``rank_error(k)`` of the rows,
for one pass over the rows and for merged days alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import join_on
from tidemark.functions.quantiles import unpivot

#: Size parameter of the sketches (8 to 65535).
K = 800


def rank_error(k: int = K) -> float:
    """Bound on the rank error: twice what KLL's analysis gives for 99 % of
    queries (2.296 / k^0.9021)."""
    return 2 * 2.296 / k ** 0.9021


def sketch(df: DataFrame, keys: Sequence[str], columns: Sequence[str], day: Column | str | None = None,
           k: int = K) -> DataFrame:
    """keys + (``day``) + ``column_name, sketch, n, total, squares, low, high``;
    nulls are left out, a null key or day is a group, a group without values has
    no row.  ``squares``: sum of squared differences from the group's mean."""
    by = [*keys] + ([] if day is None else ["day"])
    if day is not None:
        df = df.withColumn("day", F.to_date(F.col(day) if isinstance(day, str) else day))
    v = F.col("value")
    return unpivot(df, by, columns).where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, "column_name").agg(
        F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"), F.count(v).alias("n"), F.sum(v).alias("total"),
        (F.var_pop(v) * F.count(v)).alias("squares"), F.min(v).alias("low"), F.max(v).alias("high"))


def merge(states: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """States of the groups ``keys`` out of finer ones (days, or shards)."""
    mean = F.col("total") / F.col("n")
    # moments around a common centre, so that nothing cancels
    centre = states.groupBy(*keys, "column_name").agg((F.sum("total") / F.sum("n")).alias("_c"))
    return join_on(states, centre, [*keys, "column_name"]).groupBy(*keys, "column_name").agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.sum(F.col("squares") + F.col("n") * F.pow(mean - F.col("_c"), 2)).alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def quantiles(states: DataFrame, probs: Sequence[float]) -> DataFrame:
    """keys + ``column_name, n, p, q`` for every state and wanted quantile."""
    keep = [c for c in states.columns if c not in ("sketch", "total", "squares", "low", "high")]
    ps = F.array(*[F.lit(float(p)) for p in probs])
    return states.select(*keep, F.explode(F.arrays_zip(
        ps.alias("p"), F.kll_sketch_get_quantile_double("sketch", ps).alias("q"))).alias("_z")).select(*keep, "_z.*")


def summary(states: DataFrame) -> DataFrame:
    """keys + ``column_name, n, mean, stddev, low, high`` from the states alone."""
    keep = [c for c in states.columns if c not in ("sketch", "total", "squares")]
    sd = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    return states.select(*keep, (F.col("total") / F.col("n")).alias("mean"), sd.alias("stddev"))


def outside_ranks(df: DataFrame, keys: Sequence[str], columns: Sequence[str], found: DataFrame) -> DataFrame:
    """``found`` (keys, column_name, p, q) with ``rank_error``: how far p lies
    outside the exact ranks of q among the rows, as a share of them."""
    by = [*keys, "column_name"]
    v = F.col("value")
    rows = join_on(unpivot(df, keys, columns).where(v.isNotNull() & ~F.isnan(v)),
                   found.groupBy(*by).agg(F.collect_list(F.struct("p", "q")).alias("_qs")), by)
    ranks = rows.select(*by, "value", F.explode("_qs").alias("_q")).groupBy(*by, "_q").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v < F.col("_q.q")).alias("_lt"), F.count_if(v <= F.col("_q.q")).alias("_le"))
    p = F.col("_q.p")
    return ranks.select(*by, "n", p.alias("p"), F.col("_q.q").alias("q"), F.greatest(
        F.lit(0.0), F.col("_lt") / F.col("n") - p, p - F.col("_le") / F.col("n")).alias("rank_error"))
