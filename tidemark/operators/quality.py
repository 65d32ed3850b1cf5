"""Data quality and profiling (Q1-Q15).

Every statistic over many columns is one aggregation pass (the reference ran
one job per column); per-series results use ``groupBy`` with map-side partial
aggregation, and results come back long (one row per series x column) so
the number of output columns does not grow with the input width.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tidemark.functions.exprs import div, join_on
from tidemark.functions.quantiles import exact_quantiles, quantile_columns, unpivot
from tidemark.operators import ordered
from tidemark.operators.ordered import CHUNK, HALO, POS, Layout


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def overview(df: DataFrame) -> DataFrame:
    """Q1: one row per column: name, type, ordinal, row count, column count."""
    fields = df.schema.fields
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*[
            F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.lit(i + 1).alias("ordinal"))
            for i, f in enumerate(fields)])).alias("c"),
        "n_rows", F.lit(len(fields)).alias("n_columns")).select("c.*", "n_rows", "n_columns")


def _missing(df: DataFrame, c: str):
    kind = df.schema[c].dataType
    return F.col(c).isNull() | F.isnan(c) if isinstance(kind, (DoubleType, FloatType)) else F.col(c).isNull()


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q2: nulls (and NaN for doubles) per column, with percent of rows."""
    columns = list(columns or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.sum(_missing(df, c).cast("long")).alias(f"_m{i}") for i, c in enumerate(columns)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing"),
                 (F.col(f"_m{i}") * 100.0 / F.col("_n")).alias("pct_missing"))
        for i, c in enumerate(columns)])).alias("m")).select("m.*")


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q3: rows minus distinct rows (over all or the given columns)."""
    cols = list(columns or df.columns)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.sum("_c").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
            .select("n_rows", "n_distinct", (F.col("n_rows") - F.col("n_distinct"))
                    .alias("duplicates")))


COPY_CHUNK = 1 << 20


def _copies(counts: DataFrame, cols: Sequence[str], n: str = "_n") -> DataFrame:
    """Emit each row of ``counts`` ``n`` times.  Large counts are cut into
    chunks of COPY_CHUNK that are shuffled apart first, so a hot group's
    copies are generated by many tasks."""
    parts = (counts.filter(F.col(n) > 0)
             .withColumn("_part", F.explode(F.sequence(F.lit(0), F.expr(f"({n} - 1) div {COPY_CHUNK}"))))
             .repartition(*cols, "_part"))
    lo = F.col("_part") * COPY_CHUNK
    hi = F.least(F.col(n), lo + COPY_CHUNK) - 1
    return parts.withColumn("_k", F.explode(F.sequence(lo, hi))).select(*cols)


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None,
                   order: str | None = None) -> DataFrame:
    """Q4: the 2nd and later copies of each value combination (keep-first).

    ``columns`` default to all; the first copy is the one with the lowest
    ``order`` (nulls are highest; full-row ties: one of them).  Firsts come from partial
    aggregations joined back, so a hot group never lands in one window task."""
    allc = list(df.columns)
    cols = list(columns or allc)
    if order is None:
        counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        if cols != allc:
            raise ValueError("order is required when comparing a subset of columns")
        return _copies(counts.withColumn("_n", F.col("_n") - 1), allc)
    first = df.groupBy(*cols).agg(F.min(order).alias("_first")).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], "_first")
    cond = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(cols)]
    joined = df.join(first, cond, "inner")
    is_first = F.col(order).eqNullSafe(F.col("_first"))
    later = joined.filter(~is_first).select(*allc)
    ties = joined.filter(is_first).select(*allc)
    tc = ties.groupBy(*allc).agg(F.count(F.lit(1)).alias("_n"))
    keep = tc.groupBy(*cols).agg(F.min(F.struct(*allc)).alias("_keep")).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], "_keep")
    tc = (tc.join(keep, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(cols)])
          .withColumn("_n", F.col("_n") - F.when(F.struct(*allc) == F.col("_keep"), 1)
                      .otherwise(0)))
    return later.unionByName(_copies(tc, allc))


def describe(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Q5: count, mean, std (n-1), min, 25/50/75 % (linear), max per column."""
    long = unpivot(df, keys, columns)
    k = list(keys) + ["column_name"]
    basic = long.groupBy(*k).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    qs = exact_quantiles(long, k, "value", [0.25, 0.5, 0.75])
    wide = qs.groupBy(*k).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
                               for p, n in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]])
    return join_on(basic, wide, k, "left")


def summary_stats(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Q6: {c}_mean, {c}_stddev, {c}_min, {c}_max in one pass (wide)."""
    exprs = []
    for c in columns:
        exprs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_stddev"),
                  F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)


def iqr_bounds(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
               approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Q1/Q3 and 1.5 IQR fences per key x column (exact or sketch quantiles)."""
    k = list(keys) + ["column_name"]
    if approx:
        long = unpivot(df, keys, columns)
        qs = long.groupBy(*k).agg(
            F.percentile_approx("value", [0.25, 0.75], accuracy).alias("_q"),
            F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"))
        q = qs.select(*k, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"), "mean", "stddev")
    else:
        qs = quantile_columns(df, keys, columns, [0.25, 0.75])
        q = qs.groupBy(*k).agg(F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
                               F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({"lower_bound": F.col("q1") - 1.5 * iqr,
                          "upper_bound": F.col("q3") + 1.5 * iqr})


def iqr_outliers(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 approx: bool = False) -> DataFrame:
    """Q7 / Q8: outlier count and percent per key x column, strict bounds."""
    k = list(keys) + ["column_name"]
    bounds = iqr_bounds(df, keys, columns, approx)
    long = unpivot(df, keys, columns)
    counted = join_on(long, bounds, k).groupBy(*k).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if((F.col("value") < F.col("lower_bound")) |
                   (F.col("value") > F.col("upper_bound"))).alias("outliers"))
    return (join_on(bounds, counted, k)
            .withColumn("pct_outliers", F.col("outliers") * 100.0 / F.col("n_rows")))


def outlier_rows(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Q9: rows whose ``column`` lies outside the exact IQR fences."""
    b = iqr_bounds(df, keys, [column]).drop("column_name")
    x = F.col(column)
    return (join_on(df, b.select(*keys, "lower_bound", "upper_bound"), keys)
            .filter((x < F.col("lower_bound")) | (x > F.col("upper_bound")))
            .drop("lower_bound", "upper_bound"))


def zscore_clean(df: DataFrame, keys: Sequence[str], column: str, threshold: float = 3.0,
                 out: str | None = None, fit: Column | None = None) -> DataFrame:
    """Q10: |z| > threshold (population std) -> replaced by the group mean.
    With ``fit`` only the rows where it holds (the train part) are cleaned, by
    their own mean and std; the others stay as they are.

    Mean/std per group come from a partial aggregation joined back (a
    whole-group window would put a hot group in one task); zero std -> no
    outliers."""
    x = F.col(column)
    fit = F.lit(True) if fit is None else F.coalesce(fit, F.lit(False))
    st = df.filter(fit).groupBy(*keys).agg(F.avg(column).alias("_mu"), F.stddev_pop(column).alias("_sd"),
                                           (F.min(column) == F.max(column)).alias("_flat"))
    z = F.when(~F.col("_flat"), div(x - F.col("_mu"), F.col("_sd")))
    return (join_on(df, st, keys, "left")
            .withColumn(out or column, F.when(fit & (F.abs(z) > threshold), F.col("_mu")).otherwise(x))
            .drop("_mu", "_sd", "_flat"))


# ------------------------------------------------------------ fills

def forward_fill(df: DataFrame, columns: Sequence[str], layout: Layout) -> DataFrame:
    """Q11: null -> last non-null value earlier in the series.

    In-chunk ``last(ignorenulls)`` plus a carry of each earlier chunk's last
    value (chunk table prefix + join), so no task holds a whole series."""
    framed = ordered.with_halo(df, 0, layout)
    w = layout.window().rowsBetween(Window.unboundedPreceding, 0)
    framed = framed.withColumns({f"_ff_{c}": F.last(c, ignorenulls=True).over(w) for c in columns})
    carry = ordered.chunk_carry(
        framed, layout,
        {c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))) for c in columns},
        {c: (lambda name, wc: F.last(name, ignorenulls=True).over(wc)) for c in columns})
    out = join_on(framed, carry, [layout.series, CHUNK], "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_ff_{c}"), F.col(f"_carry_{c}"))
                           for c in columns})
    return ordered.strip(out)


def interpolate_linear(df: DataFrame, columns: Sequence[str], layout: Layout) -> DataFrame:
    """Q12: linear in row position between the neighbouring non-null values;
    leading nulls stay null, trailing nulls take the last value (pandas
    ``interpolate()`` defaults)."""
    s = layout.series
    framed = ordered.with_halo(df, 0, layout)
    w = layout.window()
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    # reversed running frame (an "unbounded following" frame is re-evaluated per row)
    fwd = (Window.partitionBy(s, CHUNK).orderBy(F.col(POS).desc())
           .rowsBetween(Window.unboundedPreceding, 0))
    for c in columns:
        pt = F.when(F.col(c).isNotNull(), F.struct(F.col(POS).alias("i"), F.col(c).alias("v")))
        framed = framed.withColumn(f"_pt_{c}", pt)
        framed = framed.withColumns({
            f"_pv_{c}": F.last(f"_pt_{c}", ignorenulls=True).over(back),
            f"_nx_{c}": F.last(f"_pt_{c}", ignorenulls=True).over(fwd)})
    summary = framed.filter(F.col(HALO) == 0).groupBy(s, CHUNK).agg(*[
        e for c in columns for e in (
            F.max_by(f"_pt_{c}", F.when(F.col(f"_pt_{c}").isNotNull(), F.col(POS))).alias(f"_l_{c}"),
            F.min_by(f"_pt_{c}", F.when(F.col(f"_pt_{c}").isNotNull(), F.col(POS))).alias(f"_f_{c}"))])
    before = Window.partitionBy(s).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(s).orderBy(F.col(CHUNK).desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    summary = summary.select(s, CHUNK, *[e for c in columns for e in (
        F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_cp_{c}"),
        F.last(f"_f_{c}", ignorenulls=True).over(after).alias(f"_cn_{c}"))])
    out = join_on(framed, summary, [s, CHUNK], "left")
    for c in columns:
        p = F.coalesce(F.col(f"_pv_{c}"), F.col(f"_cp_{c}"))
        n = F.coalesce(F.col(f"_nx_{c}"), F.col(f"_cn_{c}"))
        slope = (n["v"] - p["v"]) / (n["i"] - p["i"]).cast("double")
        filled = (F.when(p.isNull(), F.lit(None))
                  .when(n.isNull(), p["v"])
                  .otherwise(slope * (F.col(POS) - p["i"]).cast("double") + p["v"]))
        out = out.withColumn(c, F.coalesce(F.col(c), filled))
    return ordered.strip(out)


# ------------------------------------------------------------ distributions

def histogram(df: DataFrame, keys: Sequence[str], column: str, bins: int) -> DataFrame:
    """Q13: equal-width bins over [min, max] per group, last bin closed;
    empty bins are emitted with count 0."""
    k = list(keys)
    x = F.col(column)
    st = df.groupBy(*k).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / width * F.lit(float(bins))) + 1, F.lit(bins)))
    counts = (join_on(df.filter(x.isNotNull()), st, k).withColumn("bin", b.cast("int"))
              .groupBy(*k, "bin").agg(F.count(F.lit(1)).alias("count")))
    grid = st.select(*k, "_lo", "_hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return (join_on(grid, counts, k + ["bin"], "left")
            .select(*k, "bin",
                    (F.col("_lo") + (F.col("bin") - 1) * step).alias("bin_lower"),
                    (F.col("_lo") + F.col("bin") * step).alias("bin_upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


KDE_GRID = 200
KDE_CUT = 3.0


def kde_grid(df: DataFrame, keys: Sequence[str], column: str, grid: int = KDE_GRID,
             cut: float = KDE_CUT) -> DataFrame:
    """Q14: Gaussian KDE on an even grid of ``grid`` points over
    [min - cut h, max + cut h], Scott bandwidth h = std(ddof=1) n^(-1/5).

    Equal values are counted first; the kernel sums of all grid points are one
    partial aggregation, so no row is ever multiplied by the grid."""
    k = list(keys)
    x = F.col(column)
    st = df.groupBy(*k).agg(F.count(column).alias("_n"), F.stddev_samp(column).alias("_sd"),
                            F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    st = st.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    st = st.filter(F.col("_h") > 0)
    st = st.withColumns({"_g0": F.col("_lo") - cut * F.col("_h"),
                         "_step": (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h"))
                         / F.lit(float(grid - 1))})
    values = df.filter(x.isNotNull()).groupBy(*k, x.alias("_x")).agg(F.count(F.lit(1)).alias("_w"))
    d = join_on(values, st.select(*k, "_h", "_g0", "_step"), k)
    sums = d.groupBy(*k).agg(*[F.expr(
        f"sum(_w * exp(-0.5D * pow((_g0 + {g} * _step - _x) / _h, 2)))").alias(f"_s{g}") for g in range(grid)])
    sums = sums.select(*k, F.array(*[f"_s{g}" for g in range(grid)]).alias("_s"))
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    return (join_on(st.select(*k, "_n", "_h", "_g0", "_step"), sums, k)
            .select(*k, "_n", "_h", "_g0", "_step", F.posexplode("_s").alias("g", "_v"))
            .select(*k, "g", (F.col("_g0") + F.col("g") * F.col("_step")).alias("x"),
                    (F.col("_v") / norm).alias("density")))


def kde_binned(df: DataFrame, keys: Sequence[str], column: str, error: float = 1e-4, grid: int = KDE_GRID,
               cut: float = KDE_CUT) -> DataFrame:
    """Q14 by linear binning: the density of ``kde_grid`` to within ``error`` of
    one kernel's peak, 1 / (h sqrt(2 pi)), whatever the number of distinct values.

    A value is shared out between the two nodes around it, a fine grid of step
    h sqrt(8 error) (linear interpolation of a Gaussian is off by at most step^2 / 8
    of its largest second derivative); the kernel sums run over the occupied nodes."""
    k = list(keys)
    x = F.col(column).cast("double")
    st = df.groupBy(*k).agg(F.count(column).alias("_n"), F.stddev_samp(column).alias("_sd"),
                            F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi"))
    st = st.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).filter(F.col("_h") > 0)
    st = st.withColumns({"_g0": F.col("_lo") - cut * F.col("_h"), "_fine": F.col("_h") * math.sqrt(8 * error),
                         "_step": (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h")) / F.lit(float(grid - 1))})
    place = (F.col("_x") - F.col("_lo")) / F.col("_fine")
    nodes = join_on(df.filter(x.isNotNull()).select(*k, x.alias("_x")), st.select(*k, "_lo", "_fine"), k).groupBy(
        *k, F.floor(place).alias("_b")).agg(F.count(F.lit(1)).alias("_w"), F.sum(place - F.floor(place)).alias("_f"))
    d = join_on(nodes, st.select(*k, "_lo", "_h", "_fine", "_g0", "_step"), k)
    kernel = "exp(-0.5D * pow((_g0 + {g} * _step - _lo - {b} * _fine) / _h, 2))"
    sums = d.groupBy(*k).agg(*[F.expr(
        f"sum((_w - _f) * {kernel.format(g=g, b='_b')} + _f * {kernel.format(g=g, b='(_b + 1)')})").alias(f"_s{g}")
        for g in range(grid)])
    sums = sums.select(*k, F.array(*[f"_s{g}" for g in range(grid)]).alias("_s"))
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    return (join_on(st.select(*k, "_n", "_h", "_g0", "_step"), sums, k)
            .select(*k, "_n", "_h", "_g0", "_step", F.posexplode("_s").alias("g", "_v"))
            .select(*k, "g", (F.col("_g0") + F.col("g") * F.col("_step")).alias("x"), (F.col("_v") / norm).alias("density"),
                    (F.lit(error / math.sqrt(2 * math.pi)) / F.col("_h")).alias("bound")))


def box_stats(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Q15: min, whiskers (furthest points within 1.5 IQR), quartiles, max,
    outlier count per key x column."""
    k = list(keys) + ["column_name"]
    bounds = quantile_columns(df, keys, columns, [0.25, 0.5, 0.75]).groupBy(*k).agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
          for p, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    iqr = F.col("q3") - F.col("q1")
    bounds = bounds.withColumns({"_lf": F.col("q1") - 1.5 * iqr, "_uf": F.col("q3") + 1.5 * iqr})
    v = F.col("value")
    agg = join_on(unpivot(df, keys, columns).filter(v.isNotNull()), bounds, k).groupBy(*k).agg(
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.min(F.when(v >= F.col("_lf"), v)).alias("lower_whisker"),
        F.max(F.when(v <= F.col("_uf"), v)).alias("upper_whisker"),
        F.count_if((v < F.col("_lf")) | (v > F.col("_uf"))).alias("outliers"))
    return join_on(bounds.drop("_lf", "_uf"), agg, k)
