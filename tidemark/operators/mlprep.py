"""Splits, scaling and ML inputs (M1-M6, M11 lives in evaluate).

Per-series statistics (counts, means, standard deviations) are partial
aggregations joined back; the only window is the chunked one that numbers
rows or gathers sequence windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import div, join_on
from tidemark.operators import ordered
from tidemark.operators.ordered import HOURLY, POS, Layout


def chrono_split(df: DataFrame, layout: Layout = HOURLY, train: float = 0.8,
                 keep_pos: bool = False) -> DataFrame:
    """M1: the first int(train * n) rows of each series are 'train', the rest
    'test' (n = rows of the series)."""
    p = ordered.with_position(df, layout)
    n = ordered.series_counts(df, layout, "_n")
    out = join_on(p, n, layout.series).withColumn(
        "split", F.when(F.col(POS) < F.floor(F.col("_n") * F.lit(train)), "train")
        .otherwise("test")).drop("_n")
    return out if keep_pos else out.drop(POS)


HASH_MULT = 2654435761  # Knuth's multiplicative constant
HASH_MOD = 4294967296


def hash_split(df: DataFrame, key: str, train: float = 0.8, salt: int = 42) -> DataFrame:
    """M2, deterministic: 'train' when ((key * 2654435761 + salt) mod 2^32)
    mod 100 < 100 * train.  Repeatable across engines and re-runs (a lost
    executor recomputes the same split)."""
    k = F.pmod(F.col(key).cast("long"), F.lit(HASH_MOD))
    # in two halves of 16 bits, as the whole product may not fit a long
    high = F.pmod(F.shiftright(k, 16) * F.lit(HASH_MULT), F.lit(1 << 16)) * F.lit(1 << 16)
    h = F.pmod(high + k.bitwiseAND(F.lit(0xFFFF)) * F.lit(HASH_MULT) + F.lit(salt), F.lit(HASH_MOD))
    return df.withColumn("split", F.when(F.pmod(h, F.lit(100)) < F.lit(int(round(train * 100))),
                                         "train").otherwise("test"))


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42):
    """M2 as in MLlib practice: ``randomSplit`` (Bernoulli per partition)."""
    return df.randomSplit(list(weights), seed=seed)


def scaler_stats(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean and population std per key and column (one aggregation)."""
    exprs = []
    for c in columns:
        exprs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.groupBy(*keys).agg(*exprs)


def standard_scale(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   stats: DataFrame | None = None, suffix: str = "_scaled") -> DataFrame:
    """M4: (x - mean) / population std (sklearn StandardScaler; MLlib's
    scaler uses n-1).  Zero std -> 0 like sklearn (scale 1)."""
    st = stats if stats is not None else scaler_stats(df, keys, columns)
    out = join_on(df, st, keys, "left")
    return out.withColumns({
        f"{c}{suffix}": F.coalesce(
            div(F.col(c) - F.col(f"{c}__mean"),
                F.when(F.col(f"{c}__std") != 0, F.col(f"{c}__std"))),
            F.col(c) - F.col(f"{c}__mean"))
        for c in columns}).drop(*[f"{c}__{s}" for c in columns for s in ("mean", "std")])


def inverse_scale(df: DataFrame, keys: Sequence[str], column: str, stats: DataFrame,
                  source: str, out: str) -> DataFrame:
    """Undo M4 for one column (e.g. predictions back to price units)."""
    st = stats.select(*keys, F.col(f"{source}__mean").alias("_m"),
                      F.col(f"{source}__std").alias("_s"))
    scale = F.when(F.col("_s") != 0, F.col("_s")).otherwise(F.lit(1.0))
    return (join_on(df, st, keys, "left")
            .withColumn(out, F.col(column) * scale + F.col("_m")).drop("_m", "_s"))


def sequence_windows(df: DataFrame, features: Sequence[str], target: str, length: int = 60,
                     layout: Layout = HOURLY, flat: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """M5: for row i the features of rows i-length .. i-1 and the target of
    row i; rows without a full window are dropped (n - length per series).

    ``carry`` columns of row i are kept.  ``flat``: one array of length x k doubles (time-major), ready for a
    vector; else an array of per-step arrays."""
    def build(f, w):
        step = F.array(*[F.col(c).cast("double") for c in features])
        win = F.collect_list(step).over(w.rowsBetween(-length, -1))
        return f.withColumn("seq_window", win)
    numbered = [c for c in df.columns if c == POS]
    out = ordered.run_windows(df.select(layout.series, layout.ts, *features, target, *carry, *numbered), build,
                              length, layout, keep_pos=True)
    out = out.filter(F.size("seq_window") == length)
    seq = F.flatten("seq_window") if flat else F.col("seq_window")
    return out.select(layout.series, layout.ts, POS, seq.alias("window"),
                      F.col(target).alias("target"), *carry)
