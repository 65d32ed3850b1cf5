"""Pearson correlations (C1-C7), long form.

Every task reduces its rows to pair moments (count, means, centred products) of
all keys at once (``moments``): k(k+1)/2 rows for each key in a gathering of rows,
instead of for each row.  A partial aggregation merges them.  Pairs with a null are left out
(pairwise-complete, like pandas).  A pair with a constant side is undefined
(null): the guard is ``min = max`` rather than a zero test on a rounded standard
deviation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import join_on
from tidemark.operators.moments import gathered, grouped, products, reduced

# Feature groups of the correlation report (our column names).
FEATURE_GROUPS = {
    "Price_Based": ["close", "sma_5", "sma_20", "ema_5", "ema_20", "bb_middle", "bb_upper",
                    "bb_lower"],
    "Volume_Based": ["volume", "volume_sma_5", "volume_sma_20", "volume_ratio"],
    "Momentum": ["rsi", "macd", "macd_signal", "k_line", "d_line"],
    "Volatility": ["daily_volatility", "atr", "price_range", "price_range_pct"],
}
HIGH_CORR = 0.8
_KEYS = 500
_SPLIT = 50_000


def _extremes(x: np.ndarray, ok: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of column i among a group's rows that have
    columns i and j."""
    k, out = x.shape[1], []
    for none, best in ((np.inf, np.minimum), (-np.inf, np.maximum)):
        y = np.where(ok, x, none)

        def long(s, y=y, none=none, best=best):
            return np.stack([best.reduce(np.where(ok[s, j: j + 1], y[s], none)) for j in range(k)], axis=1)

        def short(r, first, y=y, none=none, best=best):
            return best.reduceat(np.where(ok[r][:, None, :], y[r][:, :, None], none), first, axis=0)
        out.append(reduced(start, len(x), long, short, (k, k)))
    return out[0], out[1]


def _pair_moments(x: np.ndarray, start: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of all column pairs i >= j of each group's rows (NaN: no value):
    arrays of groups x pairs."""
    ok = ~np.isnan(x)
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(x))))
    ref = np.maximum.reduceat(np.where(ok, x, -np.inf), start, axis=0)
    ref = np.where(np.isfinite(ref), ref, 0.0)
    c, v = np.where(ok, x - ref[group], 0.0), ok.astype(float)
    n = products(v, v, start)
    d = np.maximum(n, 1)
    sx = products(c, v, start)  # sum of column i over the rows where j has a value
    mean, sq = sx / d, products(c * c, v, start) - sx * sx / d
    cross = products(c, c, start) - sx * np.swapaxes(sx, 1, 2) / d
    low, high = _extremes(x, ok, start)
    mean += ref[:, :, None]
    i, j = np.tril_indices(x.shape[1])
    out = {"mx": mean, "xx": np.maximum(sq, 0), "x0": low, "x1": high}
    mirrored = {"my": "mx", "yy": "xx", "y0": "x0", "y1": "x1"}
    return {"n": n[:, i, j].astype(np.int64), "xy": cross[:, i, j], **{k: m[:, i, j] for k, m in out.items()},
            **{k: out[m][:, j, i] for k, m in mirrored.items()}}


def _co_located(data: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows dealt out by key, those of a long one in parts of about ``_SPLIT`` rows."""
    size = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    part = F.pmod(F.xxhash64(*values), F.ceil(F.col("_n") / _SPLIT))
    return join_on(data, size, keys).repartition(*keys, part).drop("_n")


def corr_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str], many_keys: bool = False) -> DataFrame:
    """Keys + column_1, column_2, i, j, n, correlation for every ordered pair.

    ``many_keys``: there are so many keys that a task meets fewer rows of each than
    there are columns.  Its moments would then be larger than the rows, so these are
    dealt out by key first (which reads ``df`` twice: persist what is costly)."""
    keys = list(keys)
    cols = list(columns)
    values = [f"_v{i}" for i in range(len(cols))]
    data = df.select(*keys, *[F.col(c).cast("double").alias(v) for c, v in zip(cols, values, strict=True)])

    if many_keys and keys:
        data = _co_located(data, keys, values)
    i, j = np.tril_indices(len(cols))

    def moments(batches):
        for pdf in gathered(batches, len(cols)):
            rows, start, key = grouped(pdf, keys)
            found = _pair_moments(rows[values].to_numpy(float), start)
            for a in range(0, len(start), _KEYS):  # pairs of so many keys at once
                part = {k: v[a: a + _KEYS].ravel() for k, v in found.items()}
                g = np.repeat(np.arange(a, min(a + _KEYS, len(start))), len(i))
                out = key.iloc[g].reset_index(drop=True).assign(i=np.tile(i, len(g) // len(i)),
                                                                j=np.tile(j, len(g) // len(i)), **part)
                yield out[out["n"] > 0]

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in data.schema.fields[:len(keys)])
    names = ("mx", "my", "xx", "yy", "xy", "x0", "x1", "y0", "y1")
    p = data.mapInPandas(moments, f"{kinds}i int, j int, n long, " + ", ".join(f"{c} double" for c in names))
    st = p.groupBy(*keys, "i", "j").agg(
        F.sum("n").alias("n"), F.expr("sum(n * mx) / sum(n)").alias("_mx"), F.expr("sum(n * my) / sum(n)").alias("_my"),
        *[F.sum(c).alias(f"_{c}") for c in ("xx", "yy", "xy")], F.expr("sum(n * mx * mx)").alias("_mxx"),
        F.expr("sum(n * my * my)").alias("_myy"), F.expr("sum(n * mx * my)").alias("_mxy"),
        (F.min("x0") == F.max("x1")).alias("_cx"), (F.min("y0") == F.max("y1")).alias("_cy"))
    cov = F.expr("_xy + _mxy - n * _mx * _my")
    var = F.expr("(_xx + _mxx - n * _mx * _mx) * (_yy + _myy - n * _my * _my)")
    r = F.when(F.col("_cx") | F.col("_cy"), F.lit(None).cast("double")).otherwise(
        F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.try_divide(cov, F.sqrt(var))))
    lower = st.select(*keys, "i", "j", "n", r.alias("correlation"))
    upper = lower.filter(F.col("i") != F.col("j")).select(
        *keys, F.col("j").alias("i"), F.col("i").alias("j"), "n", "correlation")
    names = F.array(*[F.lit(c) for c in cols])
    return lower.unionByName(upper).select(
        *keys, F.element_at(names, F.col("i") + 1).alias("column_1"),
        F.element_at(names, F.col("j") + 1).alias("column_2"), "i", "j", "n", "correlation")


def corr_pivot(long: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Square matrix, one row per (keys, column_1), one column per column."""
    return (long.groupBy(*keys, "column_1").pivot("column_2", list(columns))
            .agg(F.first("correlation")))


def high_corr_pairs(long: DataFrame, keys: Sequence[str], threshold: float = HIGH_CORR) -> DataFrame:
    """C4: lower triangle (i > j), |r| > threshold, strongest first."""
    return (long.filter((F.col("i") > F.col("j")) & (F.abs("correlation") > threshold))
            .select(*keys, F.col("column_1").alias("feature_1"),
                    F.col("column_2").alias("feature_2"), "correlation")
            .orderBy(*keys, F.abs("correlation").desc(), "feature_1", "feature_2"))


def target_corr(long: DataFrame, keys: Sequence[str], target: str = "returns",
                k: int = 10) -> DataFrame:
    """Correlations with ``target``, top k by |r| per key (ties by name);
    empty when the target column is absent."""
    w = Window.partitionBy(*keys).orderBy(F.abs("correlation").desc_nulls_last(), "feature")
    return (long.filter(F.col("column_2") == target)
            .select(*keys, F.col("column_1").alias("feature"), "correlation")
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))


def group_map(spark: SparkSession, groups: Mapping[str, Sequence[str]] = FEATURE_GROUPS) -> DataFrame:
    rows = [(g, f) for g, fs in groups.items() for f in fs]
    return spark.createDataFrame(rows, "feature_group string, feature string")


def group_corr(long: DataFrame, groups: DataFrame) -> DataFrame:
    """The sub-matrix of each feature group (absent features skipped)."""
    g1 = groups.select("feature_group", F.col("feature").alias("column_1"))
    g2 = groups.select(F.col("feature_group").alias("_g2"), F.col("feature").alias("column_2"))
    return (g1.join(long, "column_1")
            .join(g2, "column_2")
            .filter(F.col("feature_group") == F.col("_g2")).drop("_g2"))


def group_corr_mean(sub: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of the column means of each group matrix (diagonal included)."""
    col_means = sub.groupBy(*keys, "feature_group", "column_2").agg(
        F.avg("correlation").alias("_m"))
    return col_means.groupBy(*keys, "feature_group").agg(F.avg("_m").alias("mean_correlation"))
