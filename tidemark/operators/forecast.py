"""Seasonal ARIMA forecasting re-expressed for many series.

The data-heavy parts are Spark jobs: differencing and lag design are chunked
window lags, the least-squares systems are ``groupBy(series)`` sums of cross
products (map-side partial aggregation), residuals are column arithmetic.
Only the k x k solves run in Python (``applyInPandas`` on one summary row per
series), and forecasts are computed per test row by ``mapInPandas`` from a
small per-series state (companion-matrix powers), so no series is ever
gathered into one task.

Estimation starts with Hannan-Rissanen two-stage least squares (long AR ->
residuals -> regression on AR lags and lagged residuals) and goes on with
Gauss-Newton steps on the conditional sum of squares under the seasonal product
constraint (``css``), not maximum likelihood in state space: coefficients differ
from such a fit by design.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import join_on
from tidemark.operators import css, ordered
from tidemark.operators.moments import gathered, grouped, products
from tidemark.operators.ordered import HOURLY, POS, Layout
from tidemark.session import materialize


@dataclass(frozen=True)
class Order:
    """(p, d, q) x (P, D, Q, s); only d, D in {0, 1} are supported."""

    p: int = 1
    d: int = 1
    q: int = 1
    P: int = 1
    D: int = 1
    Q: int = 1
    s: int = 5

    def ar_lags(self) -> list[int]:
        return poly_lags(self.p, self.P, self.s)

    def ma_lags(self) -> list[int]:
        return poly_lags(self.q, self.Q, self.s)

    def diff_lags(self) -> dict[int, int]:
        """Coefficients of (1-L)^d (1-L^s)^D as {lag: coef} (lag 0 excluded)."""
        poly = {0: 1}
        for step, times in ((1, self.d), (self.s, self.D)):
            for _ in range(times):
                new: dict[int, int] = {}
                for k, c in poly.items():
                    new[k] = new.get(k, 0) + c
                    new[k + step] = new.get(k + step, 0) - c
                poly = new
        return {k: c for k, c in poly.items() if k and c}


# The orders used by the three forecasting variants.
ORDER_A = Order(1, 1, 1, 1, 1, 1, 5)
ORDER_B = Order(2, 1, 2, 1, 1, 1, 5)
LONG_AR = 20
Z95 = 1.959963984540054


def poly_lags(n: int, N: int, s: int) -> list[int]:
    """Lags with a free coefficient in (1 + a_1 L .. a_n L^n)(1 + b_1 L^s .. b_N L^{sN})."""
    out = set(range(1, n + 1)) | {s * j for j in range(1, N + 1)}
    out |= {i + s * j for i in range(1, n + 1) for j in range(1, N + 1)}
    return sorted(out)


def seasonal_difference(df: DataFrame, column: str = "close", order: Order = ORDER_A,
                        layout: Layout = HOURLY, out: str = "w") -> DataFrame:
    """w = (1-L)^d (1-L^s)^D y (null until enough history)."""
    coefs = order.diff_lags()
    halo = max(coefs) if coefs else 1

    def build(f, w):
        expr = F.col(column)
        for k, c in sorted(coefs.items()):
            expr = expr + F.lit(float(c)) * F.lag(column, k).over(w)
        return f.withColumn(out, expr)
    return ordered.run_windows(df, build, halo, layout)


def lag_design(df: DataFrame, column: str, lags: Sequence[int], layout: Layout = HOURLY,
               prefix: str = "lag_", keep_pos: bool = False) -> DataFrame:
    """one column per lag of ``column``."""
    lags = list(lags)

    def build(f, w):
        return f.withColumns({f"{prefix}{k}": F.lag(column, k).over(w) for k in lags})
    return ordered.run_windows(df, build, max(lags), layout, keep_pos=keep_pos)


def seasonal_naive_one_step(df: DataFrame, column: str = "close", s: int = 5,
                            layout: Layout = HOURLY, out: str = "predicted") -> DataFrame:
    """One-step-ahead (0,1,0)(0,1,0,s) prediction y[t-1] + y[t-s] - y[t-s-1]."""
    def build(f, w):
        return f.withColumn(out, F.lag(column, 1).over(w) + F.lag(column, s).over(w)
                            - F.lag(column, s + 1).over(w))
    return ordered.run_windows(df, build, s + 1, layout)


def seasonal_naive_ahead(df: DataFrame, column: str = "close", s: int = 5, grain: str = "1 hour",
                         layout: Layout = HOURLY) -> DataFrame:
    """``series, made_ts, target_ts, predicted_price``: at every bar, the (0,1,0)
    (0,1,0,s) prediction of the next one; none where history is missing."""
    def build(f, w):
        return f.withColumn("predicted_price", F.col(column) + F.lag(column, s - 1).over(w) - F.lag(column, s).over(w))
    out = ordered.run_windows(df, build, s + 1, layout)
    return out.where("predicted_price IS NOT NULL").select(
        "series", F.col(layout.ts).alias("made_ts"), F.expr(f"`{layout.ts}` + INTERVAL {grain}").alias("target_ts"),
        "predicted_price")


def seasonal_naive_forecast(split: DataFrame, column: str = "close", s: int = 5) -> DataFrame:
    """h-step (0,1,0)(0,1,0,s) forecast of the test rows from the train end.

    z = y - y[-s] is constant after the train end T, so
    y[T+h] = y[T - s + r] + k z[T] with h = s (k - 1) + r, 1 <= r <= s.
    Input: ``chrono_split(..., keep_pos=True)`` output."""
    train = split.filter(F.col("split") == "train")
    end = train.groupBy("series").agg(F.max(POS).alias("_T"))
    tail = (join_on(train, end, "series").filter(F.col(POS) > F.col("_T") - (s + 1))
            .select("series", (F.col(POS) - F.col("_T")).alias("_off"), F.col(column).alias("_y")))
    state = tail.groupBy("series").agg(*[
        F.max(F.when(F.col("_off") == -k, F.col("_y"))).alias(f"_y{k}") for k in range(s + 1)])
    test = join_on(join_on(split.filter(F.col("split") == "test"), end, "series"), state, "series")
    h = F.col(POS) - F.col("_T")
    r = F.pmod(h - 1, F.lit(s)) + 1
    k = F.floor((h - 1) / F.lit(s)) + 1
    z = F.col("_y0") - F.col(f"_y{s}")
    base = F.lit(None).cast("double")
    for rr in range(1, s + 1):
        base = F.when(r == rr, F.col(f"_y{s - rr}")).otherwise(base)
    return test.select("series", "bar_ts", F.col(column).alias("actual"),
                       (base + k.cast("double") * z).alias("predicted"))


# ------------------------------------------------------------------ fitting

_SOLVE_SCHEMA = "series string, beta array<double>, sigma2 double, n long"
RIDGE = 1e-8


def normal_equations(df: DataFrame, xcols: Sequence[str], y: str) -> DataFrame:
    """Long cross-product sums of z = x ++ [y] per series: (series, i, j, s, n).

    Each task reduces its rows by series (``moments``); a partial aggregation adds
    the sums up.  Rows with a null take no part."""
    names = [*xcols, y]
    i, j = np.triu_indices(len(names))

    def sums(batches):
        for pdf in gathered(batches, len(names)):
            pdf = pdf[~pdf[names].isna().any(axis=1)]
            if len(pdf):
                rows, start, key = grouped(pdf, ["series"])
                z = rows[names].to_numpy(float)
                found = products(z, z, start)[:, i, j]
                n = np.diff(np.append(start, len(z)))
                yield pd.DataFrame({"i": np.tile(i, len(n)), "j": np.tile(j, len(n)), "s": found.ravel(),
                                    "n": np.repeat(n, len(i)), "series": np.repeat(key["series"].to_numpy(), len(i))})

    data = df.select("series", *[F.col(c).cast("double").alias(c) for c in names])
    kind = data.schema["series"].dataType.simpleString()
    return (data.mapInPandas(sums, f"i int, j int, s double, n long, series {kind}")
            .groupBy("series", "i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))


def _solve(pdf: pd.DataFrame) -> pd.DataFrame:
    """k x k least squares from one series' cross-product sums (tiny input)."""
    k = int(pdf["j"].max())
    m = np.zeros((k + 1, k + 1))
    m[pdf["i"].to_numpy(), pdf["j"].to_numpy()] = pdf["s"].to_numpy()
    m = m + np.triu(m, 1).T
    xtx, xty, yty = m[:k, :k], m[:k, k], m[k, k]
    n = int(pdf["n"].iloc[0])
    ridge = RIDGE * max(np.trace(xtx) / max(k, 1), 1e-300)
    beta = np.linalg.solve(xtx + ridge * np.eye(k), xty) if k else np.zeros(0)
    sse = float(yty - 2 * beta @ xty + beta @ xtx @ beta)
    return pd.DataFrame({"series": [pdf["series"].iloc[0]], "beta": [beta.tolist()],
                         "sigma2": [max(sse, 0.0) / max(n, 1)], "n": [n]})


def least_squares(design: DataFrame, xcols: Sequence[str], y: str) -> DataFrame:
    """Per-series OLS of y on the columns xcols: (series, beta, sigma2, n)."""
    return normal_equations(design, xcols, y).groupBy("series").applyInPandas(
        _solve, _SOLVE_SCHEMA)


def _dot(coefs: str, values: str):
    """sum(coefs[i] * values[i]) as a JVM expression."""
    return F.aggregate(F.zip_with(F.col(coefs), F.col(values), lambda a, b: a * b),
                       F.lit(0.0), lambda acc, v: acc + v)


def _complete(cols: list[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def sarima_fit(split: DataFrame, column: str = "close", order: Order = ORDER_A,
               long_ar: int = LONG_AR, layout: Layout = HOURLY, steps: int = css.STEPS):
    """Hannan-Rissanen start and ``steps`` Gauss-Newton steps on the train
    rows of each series.

    Input: ``chrono_split(bars, keep_pos=True)``.  Returns (model, frame):
    model = (series, ar array, ma array, sigma2, n) with coefficients on
    ``order.ar_lags()`` / ``order.ma_lags()`` of the differenced series, those of
    the cross lags being products (see ``css``); frame = train rows with y, w
    (differenced) and the residuals ``e`` (0 where a lag of w is missing).
    """
    ar, ma = order.ar_lags(), order.ma_lags()
    base = split.filter(F.col("split") == "train").select(
        "series", "bar_ts", POS, F.col(column).cast("double").alias("y"))
    w = seasonal_difference(base, "y", order, layout, out="w")
    start = _start(w, ar, ma, long_ar, layout)
    blocks = materialize(css.pack(w, max(ar, default=0), layout))
    return css.fit(blocks, start, order, steps)


def _start(w: DataFrame, ar: list[int], ma: list[int], long_ar: int, layout: Layout) -> DataFrame:
    """(series, beta): two-stage least squares with a free coefficient for every
    lag; the first stage, a long autoregression, gives the residuals that the
    second one lags.  Without lags there is nothing to estimate."""
    if not ar and not ma:
        return w.select("series").distinct().withColumn("beta", F.array().cast("array<double>"))
    if ma:
        d1 = lag_design(w, "w", range(1, long_ar + 1), layout, prefix="lw")
        lcols = [f"lw{k}" for k in range(1, long_ar + 1)]
        d1 = d1.withColumn("_x1", F.array(*[F.col(c) for c in lcols]))
        stage1 = materialize(least_squares(d1.filter(_complete(["w"] + lcols)), lcols, "w"))
        w = join_on(d1, stage1.select("series", F.col("beta").alias("_b1")), "series", "left").withColumn(
            "e1", F.when(_complete(["w"] + lcols), F.col("w") - _dot("_b1", "_x1"))).select(
            "series", "bar_ts", POS, "w", "e1")
    lagcols = {f"aw{k}": ("w", k) for k in ar} | {f"ae{k}": ("e1", k) for k in ma}

    def build(f, wdw):
        return f.withColumns({n: F.lag(c, k).over(wdw) for n, (c, k) in lagcols.items()})
    d2 = ordered.run_windows(w, build, max(ar + ma), layout, keep_pos=True)
    return least_squares(d2.filter(_complete(["w"] + list(lagcols))), list(lagcols), "w").select("series", "beta")


def _full_ar(order: Order, ar: Sequence[float]) -> np.ndarray:
    """Coefficients a_1..a_P of y_t = sum a_j y_{t-j} + MA terms + e_t."""
    phi = np.zeros(max(order.ar_lags() or [0]) + 1)
    phi[0] = 1.0
    for lag, c in zip(order.ar_lags(), ar):
        phi[lag] -= c
    diff = np.zeros(max(order.diff_lags() or [0]) + 1)
    diff[0] = 1.0
    for lag, c in order.diff_lags().items():
        diff[lag] = c
    total = np.convolve(phi, diff)
    return -total[1:]


def _companion(a: np.ndarray, theta_lags: Sequence[int], theta: Sequence[float]):
    P = max(len(a), 1)
    Q = max(theta_lags or [0])
    k = P + Q
    A = np.zeros((k, k))
    A[0, :len(a)] = a
    for lag, c in zip(theta_lags, theta):
        A[0, P + lag - 1] = c
    for r in range(1, P):
        A[r, r - 1] = 1.0
    for r in range(P + 1, P + Q):
        A[r, r - 1] = 1.0
    b = np.zeros(k)
    b[0] = 1.0
    if Q:
        b[P] = 1.0
    return A, b, P, Q


def power_and_sum_batched(A: np.ndarray, M: np.ndarray, h: np.ndarray):
    """Row-wise (A_r^h_r, sum_{j<h_r} A_r^j M_r A_r'^j) for stacked (n, k, k)
    matrices: binary doubling from the lowest bit, all rows per numpy op."""
    n, k, _ = A.shape
    eye = np.broadcast_to(np.eye(k), (n, k, k))
    p_acc, s_acc = eye.copy(), np.zeros((n, k, k))
    p_pow, s_pow = A.copy(), M.copy()          # A^(2^i), S_(2^i)
    rem = h.astype(np.int64).copy()
    while (rem > 0).any():
        take = (rem & 1).astype(bool)[:, None, None]
        # S_(a+b) = S_a + A^a S_b A^a', A^(a+b) = A^a A^b
        s_new = s_acc + p_acc @ s_pow @ np.swapaxes(p_acc, 1, 2)
        s_acc = np.where(take, s_new, s_acc)
        p_acc = np.where(take, p_acc @ p_pow, p_acc)
        s_pow = s_pow + p_pow @ s_pow @ np.swapaxes(p_pow, 1, 2)
        p_pow = p_pow @ p_pow
        rem >>= 1
    return p_acc, s_acc


FORECAST_SCHEMA = ("series string, bar_ts timestamp_ntz, actual double, predicted double, "
                   "lower double, upper double")


def sarima_forecast(split: DataFrame, column: str = "close", order: Order = ORDER_A,
                    long_ar: int = LONG_AR, layout: Layout = HOURLY, log: bool = False) -> DataFrame:
    """F4 + F5 (+ F6 with ``log``): point forecast and 95 % interval for every
    test row, h = steps after the last train row.

    The per-series state (last P values, last Q residuals, coefficients) is
    a few dozen numbers; every Arrow batch of test rows computes A^h s and the
    interval sums with one batched doubling (``power_and_sum_batched``) in
    ``mapInPandas`` — rows of one series spread over tasks, no per-row loop
    over the powers."""
    src = split.withColumn("_actual", F.col(column).cast("double"))
    src = materialize(src.withColumn(column, F.log(column)) if log else src)
    model, frame = sarima_fit(src, column, order, long_ar, layout)
    depth = len(_full_ar(order, [0.0] * len(order.ar_lags()))) + max(order.ma_lags() or [0])
    end = src.filter(F.col("split") == "train").groupBy("series").agg(F.max(POS).alias("_T"))
    tail = join_on(frame, end, "series").filter(F.col(POS) > F.col("_T") - depth)
    state = tail.groupBy("series").agg(
        F.sort_array(F.collect_list(F.struct(POS, "y", "e")), asc=False).alias("_st"))
    known = join_on(join_on(end, state, "series"), model, "series")
    test = src.filter(F.col("split") == "test").select("series", "bar_ts", POS, "_actual")
    test = join_on(test, known, "series").select(
        "series", "bar_ts", F.col("_actual").alias("actual"), (F.col(POS) - F.col("_T")).alias("h"),
        F.col("_st").alias("state"), "ar", "ma", "sigma2")
    ma_lags = order.ma_lags()

    def run(batches):
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            mats, states, bvecs = [], [], []  # one of each for every series in the batch
            code, _ = pd.factorize(pdf["series"], use_na_sentinel=False)
            first = np.unique(code, return_index=True)[1]
            for ar, ma, state in zip(*(pdf[c].iloc[first] for c in ("ar", "ma", "state")), strict=True):
                A, b, P, Q = _companion(_full_ar(order, ar), ma_lags, ma)
                st = np.zeros(P + Q)
                ys = [s["y"] for s in state][:P]
                es = [s["e"] for s in state][:Q]
                st[:len(ys)] = ys
                st[P:P + len(es)] = es
                mats.append(A), states.append(st), bvecs.append(b)
            A = np.stack(mats)[code]
            b = np.stack(bvecs)[code]
            Ph, Sh = power_and_sum_batched(A, b[:, :, None] * b[:, None, :], pdf["h"].to_numpy())
            mean = np.einsum("nk,nk->n", Ph[:, 0, :], np.stack(states)[code])
            half = Z95 * np.sqrt(np.clip(pdf["sigma2"].to_numpy(), 0, None) * Sh[:, 0, 0])
            res = pd.DataFrame({"series": pdf["series"], "bar_ts": pdf["bar_ts"],
                                "actual": pdf["actual"], "predicted": mean,
                                "lower": mean - half, "upper": mean + half})
            if log:
                res[["predicted", "lower", "upper"]] = np.exp(res[["predicted", "lower", "upper"]])
            yield res
    return test.mapInPandas(run, FORECAST_SCHEMA)
