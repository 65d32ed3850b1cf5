"""Forecast evaluation (E1-E9, W24, W25) on frames
``(series, bar_ts, actual, predicted)``.

Per-series metrics are single ``groupBy`` aggregations (map-side partial
aggregation; a hot series is pre-reduced in every task).  Direction metrics
need the previous row, so they run through the chunked layout first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import direction, div, frame, join_on
from tidemark.functions.quantiles import exact_quantiles
from tidemark.operators import ordered
from tidemark.operators.ordered import CHUNK, HALO, HOURLY, POS, Layout

A, P = "actual", "predicted"


def align(actual: DataFrame, predicted: DataFrame, keys=("series", "bar_ts")) -> DataFrame:
    """Pair actual and predicted values on (series, bar_ts)."""
    return actual.join(predicted, list(keys), "inner")


def align_by_position(actual: DataFrame, predicted: DataFrame, skip: int = 0, value: str = "predicted",
                      layout: Layout = HOURLY) -> DataFrame:
    """E9 without common keys: within a series, the n-th row of ``predicted`` (its
    column ``value``, in the order of its time) stands beside the n-th row of
    ``actual`` behind the first ``skip`` ones (a window model predicts nothing for
    those); the longer side is trimmed."""
    rows = ordered.with_position(actual, layout).where(F.col(POS) >= skip).withColumn(POS, F.col(POS) - skip)
    made = ordered.with_position(predicted.select(layout.series, layout.ts, value), layout).drop(layout.ts)
    return join_on(rows, made, [layout.series, POS]).drop(POS)


def residuals(df: DataFrame) -> DataFrame:
    """E7."""
    return df.select("series", "bar_ts", (F.col(A) - F.col(P)).alias("residual"))


def prediction_errors(df: DataFrame, actual: str = A, predicted: str = P) -> DataFrame:
    """Absolute error and its percent of the actual value."""
    err = F.abs(F.col(predicted) - F.col(actual))
    return df.withColumns({"prediction_error": err,
                           "prediction_error_pct": div(err, F.col(actual)) * F.lit(100.0)})


def regression_metrics(df: DataFrame, keys=("series",)) -> DataFrame:
    """N, MSE, RMSE, MAE, MAPE (%), R^2 = 1 - SSE/SST per key."""
    e = F.col(A) - F.col(P)
    m = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(div(e, F.col(A)))) * 100.0).alias("mape"),
        F.sum(e * e).alias("_sse"), F.var_pop(A).alias("_var"))
    r2 = F.lit(1.0) - div(F.col("_sse"), F.col("_var") * F.col("n"))
    return m.select(*keys, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", "mape", r2.alias("r2"))


def _with_moves(df: DataFrame, layout: Layout, pct: bool) -> DataFrame:
    """Add actual/predicted move per row: diff (pct=False) or pct change."""
    def build(f, w):
        pa, pp = F.lag(A).over(w), F.lag(P).over(w)
        if pct:
            ma, mp = div(F.col(A), pa) - 1, div(F.col(P), pp) - 1
        else:
            ma, mp = F.col(A) - pa, F.col(P) - pp
        return f.withColumns({"move_actual": ma, "move_predicted": mp})
    return ordered.run_windows(df, build, 1, layout)


def directional_accuracy_diff(df: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    """% of rows where sign(diff(actual)) == sign(diff(predicted)); n-1
    comparisons per series, a zero move matches only a zero move."""
    m = _with_moves(df, layout, pct=False).filter(
        F.col("move_actual").isNotNull() & F.col("move_predicted").isNotNull())
    hit = (direction("move_actual") == direction("move_predicted")).cast("double")
    return m.groupBy("series").agg(F.count(F.lit(1)).alias("comparisons"),
                                   (F.avg(hit) * 100.0).alias("directional_accuracy"))


def direction_frame(df: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    """Signs of the pct changes (first row dropped, as after ``dropna``)."""
    m = _with_moves(df, layout, pct=True).filter(
        F.col("move_actual").isNotNull() & F.col("move_predicted").isNotNull())
    return m.withColumns({"dir_actual": direction("move_actual"),
                          "dir_predicted": direction("move_predicted")})


def directional_metrics(dirs: DataFrame) -> DataFrame:
    """Overall / up / down accuracy in % (0 when a side has no rows)."""
    hit = (F.col("dir_actual") == F.col("dir_predicted")).cast("double")
    up, down = F.col("dir_actual") > 0, F.col("dir_actual") < 0
    return dirs.groupBy("series").agg(
        (F.avg(hit) * 100.0).alias("overall_accuracy"),
        F.coalesce(F.avg(F.when(up, hit)) * 100.0, F.lit(0.0)).alias("up_accuracy"),
        F.coalesce(F.avg(F.when(down, hit)) * 100.0, F.lit(0.0)).alias("down_accuracy"))


def confusion_counts(dirs: DataFrame) -> DataFrame:
    """(actual, predicted, n) over up/down moves; zero moves excluded."""
    lab = lambda c: F.when(F.col(c) > 0, "up").when(F.col(c) < 0, "down")
    return (dirs.select("series", lab("dir_actual").alias("actual_direction"),
                        lab("dir_predicted").alias("predicted_direction"))
            .dropna().groupBy("series", "actual_direction", "predicted_direction")
            .agg(F.count(F.lit(1)).alias("n")))


def precision_recall_f1(dirs: DataFrame) -> DataFrame:
    """E5: precision / recall / F1 of the "up" class in %, 0 on empty denominators."""
    a, p = F.col("dir_actual"), F.col("dir_predicted")
    c = dirs.groupBy("series").agg(
        F.count_if((a > 0) & (p > 0)).alias("tp"), F.count_if((a < 0) & (p < 0)).alias("tn"),
        F.count_if((a < 0) & (p > 0)).alias("fp"), F.count_if((a > 0) & (p < 0)).alias("fn"))
    prec = F.coalesce(div(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(div(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    c = c.withColumns({"precision": prec, "recall": rec})
    f1 = F.coalesce(div(2 * F.col("precision") * F.col("recall"),
                        F.col("precision") + F.col("recall")), F.lit(0.0))
    return c.select("series", "tp", "tn", "fp", "fn", (F.col("precision") * 100).alias("precision"),
                    (F.col("recall") * 100).alias("recall"), (f1 * 100).alias("f1"))


def error_summary(df: DataFrame) -> DataFrame:
    """N, actual / predicted ranges, population std, mean, median of a - p."""
    e = (F.col(A) - F.col(P)).alias("err")
    st = df.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.min(A).alias("actual_min"), F.max(A).alias("actual_max"),
        F.min(P).alias("predicted_min"), F.max(P).alias("predicted_max"),
        F.stddev_pop(e).alias("error_std"), F.avg(e).alias("error_mean"))
    med = exact_quantiles(df.select("series", e), ["series"], "err", [0.5]).select(
        "series", F.col("q").alias("error_median"))
    return join_on(st, med, "series", "left")


def evaluation_report(df: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    """E1 + E2 + E6 in one row per series."""
    both = join_on(regression_metrics(df), directional_accuracy_diff(df, layout), "series")
    return join_on(both, error_summary(df).drop("n"), "series")


def rolling_accuracy(dirs: DataFrame, layout: Layout = HOURLY, n: int = 20) -> DataFrame:
    """% of direction hits over the last n direction rows (full frames)."""
    hit = (F.col("dir_actual") == F.col("dir_predicted")).cast("double")
    base = dirs.select("series", "bar_ts", hit.alias("_hit"))

    def build(f, w):
        v = F.when(F.count("_hit").over(frame(w, n)) == n,
                   F.avg("_hit").over(frame(w, n)) * 100.0)
        return f.withColumn("rolling_accuracy", v)
    return ordered.run_windows(base, build, n, layout).drop("_hit")


def cumulative_return(dirs: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    """Running product of (1 + pct change) for actual and predicted.

    In-chunk running ``product`` times the product of all earlier chunks
    (chunk table prefix), so no task holds a whole series."""
    base = dirs.select("series", "bar_ts", (1 + F.col("move_actual")).alias("_ga"),
                       (1 + F.col("move_predicted")).alias("_gp"))
    framed = ordered.with_halo(base, 0, layout)
    run = layout.window().rowsBetween(Window.unboundedPreceding, 0)
    framed = framed.withColumns({"_ra": F.product("_ga").over(run),
                                 "_rp": F.product("_gp").over(run)})
    s = layout.series
    summary = framed.filter(F.col(HALO) == 0).groupBy(s, CHUNK).agg(
        F.product("_ga").alias("_ca"), F.product("_gp").alias("_cp"))
    before = Window.partitionBy(s).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(s, CHUNK, F.product("_ca").over(before).alias("_pa"),
                             F.product("_cp").over(before).alias("_pp"))
    out = join_on(framed, summary, [s, CHUNK], "left").select(
        s, "bar_ts", POS, HALO,
        (F.col("_ra") * F.coalesce(F.col("_pa"), F.lit(1.0))).alias("cum_actual"),
        (F.col("_rp") * F.coalesce(F.col("_pp"), F.lit(1.0))).alias("cum_predicted"))
    return ordered.strip(out)
