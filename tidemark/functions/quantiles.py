"""Exact quantiles (linear interpolation) without holding a group in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer; a hot group would not fit.  Here, whatever the group's size:

1. one pass: ``count`` and a ``percentile_approx`` sketch per group at
   p -/+ 3/ACCURACY (rank error of the sketch <= n/ACCURACY) give a band of
   values around each wanted rank;
2. second pass, all bands of a group tested in one projection: rows below a band
   are only counted, next to the largest value below it and the smallest above;
   rows inside are grouped by value, about 6 n / ACCURACY distinct values;
3. a running count over the band's distinct values finds the two order
   statistics floor/ceil(p (n-1)).  A rank just outside the band is the
   neighbouring value; one further off raises an error, never a wrong result.

Input is long form: group columns + one value column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import join_on

ACCURACY = 100_000
_MARGIN = 3.0 / ACCURACY


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float]) -> DataFrame:
    """Return keys + ``p`` + ``q`` (quantile of ``value`` at p), one row per
    (group, p); nulls are ignored; groups with no values are absent.  A null
    key is a group like any other."""
    keys = list(keys)
    probs = [float(p) for p in probs]
    cuts = [max(0.0, p - _MARGIN) for p in probs] + [min(1.0, p + _MARGIN) for p in probs]
    data = df.select(*keys, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    stats = data.groupBy(*keys).agg(
        F.count("_x").alias("_n"), F.percentile_approx("_x", cuts, ACCURACY).alias("_ap"))
    k = len(probs)
    x = F.col("_x")
    lo, hi = ([F.col("_ap")[i] for i in range(k)], [F.col("_ap")[k + i] for i in range(k)])
    joined = join_on(data, stats, keys)
    sides = joined.groupBy(*keys).agg(F.first("_n").alias("_n"), *[e for i in range(k) for e in (
        F.count_if(x < lo[i]).alias(f"_b{i}"), F.max(F.when(x < lo[i], x)).alias(f"_p{i}"),
        F.min(F.when(x > hi[i], x)).alias(f"_s{i}"))])
    sides = sides.select(*keys, "_n", F.explode(F.array(*[F.struct(
        F.lit(i).alias("_i"), F.lit(p).alias("p"), F.col(f"_b{i}").alias("_below"), F.col(f"_p{i}").alias("_prev"),
        F.col(f"_s{i}").alias("_next")) for i, p in enumerate(probs)])).alias("_e")).select(*keys, "_n", "_e.*")
    hits = F.filter(F.array(*[F.when((x >= lo[i]) & (x <= hi[i]), F.lit(i)) for i in range(k)]),
                    lambda i: i.isNotNull())
    inband = (joined.select(*keys, "_x", F.explode(hits).alias("_i"))
              .groupBy(*keys, "_i", "_x").agg(F.count(F.lit(1)).alias("_c")))
    wr = Window.partitionBy(*keys, "_i").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_on(inband.withColumn("_cum", F.sum("_c").over(wr)), sides, [*keys, "_i"])
    r = F.col("p") * (F.col("_n") - 1)
    cum = F.col("_below") + F.col("_cum")
    group = [*keys, "_i", "p", "_n", "_below", "_prev", "_next"]
    picked = ranked.groupBy(*group).agg(
        F.max(cum).alias("_upto"), F.min(F.when(cum > F.floor(r), x)).alias("_v_lo"),
        F.min(F.when(cum > F.ceil(r), x)).alias("_v_hi"))

    def at(rank: Column, inside: str) -> Column:
        return (F.when((rank >= F.col("_below")) & (rank < F.col("_upto")), F.col(inside))
                .when(rank == F.col("_upto"), F.col("_next"))
                .when(rank == F.col("_below") - 1, F.col("_prev"))
                .otherwise(F.raise_error(F.lit("quantile rank outside the sketch's band")).cast("double")))
    frac = r - F.floor(r)
    low = at(F.floor(r), "_v_lo")
    q = F.when(frac == 0, low).otherwise(low + (at(F.ceil(r), "_v_hi") - low) * frac)
    return picked.select(*keys, "p", q.alias("q"))


def quantile_columns(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     probs: Sequence[float]) -> DataFrame:
    """Quantiles of several columns: keys + ``column_name`` + ``p`` + ``q``."""
    long = unpivot(df, keys, columns)
    return exact_quantiles(long, list(keys) + ["column_name"], "value", probs)


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys + (column_name, value double) — one output row per input row and column."""
    return df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in columns])).alias("_u")).select(*keys, "_u.column_name", "_u.value")
