"""Forecasting: coefficient recovery, closed forms, consistency."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tidemark.operators import css
from tidemark.operators import forecast as fc
from tidemark.operators import mlprep as mp
from tidemark.plans import fixtures as fx


def power_and_sum(A: np.ndarray, M: np.ndarray, h: int):
    """(A^h, sum_{j<h} A^j M A'^j) by binary doubling."""
    k = A.shape[0]
    Pm, Sm = np.eye(k), np.zeros((k, k))
    for bit in bin(h)[2:]:
        Sm = Sm + Pm @ Sm @ Pm.T
        Pm = Pm @ Pm
        if bit == "1":
            Sm = M + A @ Sm @ A.T
            Pm = A @ Pm
    return Pm, Sm


def _series_frame(spark, ys: dict):
    rows = []
    for name, y in ys.items():
        ts = pd.date_range("2020-01-01", periods=len(y), freq="D")
        rows.append(pd.DataFrame({"series": name, "bar_ts": ts, "close": y}))
    pdf = pd.concat(rows)
    return spark.createDataFrame(pdf).withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))


def test_hannan_rissanen_recovers_arma11(spark):
    rng = np.random.default_rng(11)
    ys = {}
    for i in range(12):
        e = rng.normal(size=1209)
        w = np.zeros_like(e)
        for t in range(1, len(e)):
            w[t] = 0.5 * w[t - 1] + e[t] + 0.3 * e[t - 1]
        ys[f"s{i}"] = 100 + np.cumsum(w[200:])
    split = mp.chrono_split(_series_frame(spark, ys), fx.LAYOUTS["daily"], train=1.0,
                            keep_pos=True)
    order = fc.Order(1, 1, 1, 0, 0, 0, 5)
    model, _ = fc.sarima_fit(split, "close", order, layout=fx.LAYOUTS["daily"])
    m = model.toPandas()
    ar = np.array([a[0] for a in m["ar"]])
    ma = np.array([b[0] for b in m["ma"]])
    assert abs(ar.mean() - 0.5) < 0.06
    assert abs(ma.mean() - 0.3) < 0.06
    assert abs(m["sigma2"].mean() - 1.0) < 0.1


def test_order_lags():
    assert fc.ORDER_B.ar_lags() == [1, 2, 5, 6, 7]
    assert fc.ORDER_A.ar_lags() == [1, 5, 6]
    assert fc.ORDER_A.diff_lags() == {1: -1, 5: -1, 6: 1}


def test_companion_forecast_equals_seasonal_naive(spark):
    bars = fx.bars_hourly(spark, SF_MID)
    split = mp.chrono_split(bars, keep_pos=True)
    naive = fc.seasonal_naive_forecast(split).toPandas().sort_values(["series", "bar_ts"])
    # a (0,1,0)(0,1,0,5) model has no coefficients: the companion recursion
    # must reproduce the closed form exactly
    a = fc._full_ar(fc.Order(0, 1, 0, 0, 1, 0, 5), [])
    A, b, P, Q = fc._companion(a, [], [])
    for s, g in naive.groupby("series"):
        hist = split.filter((F.col("series") == s) & (F.col("split") == "train")) \
            .toPandas().sort_values("bar_ts")["close"].to_numpy()
        st = hist[::-1][:P]
        for h, want in enumerate(g["predicted"].to_numpy()[:12], start=1):
            Ph, _ = power_and_sum(A, np.outer(b, b), h)
            assert abs((Ph @ st)[0] - want) < 1e-9 * max(1, abs(want))


def test_interval_widens_with_horizon(spark):
    split = mp.chrono_split(fx.bars_hourly(spark, SF_MID), keep_pos=True)
    out = fc.sarima_forecast(split, "close", fc.ORDER_A).toPandas()
    for _, g in out.groupby("series"):
        g = g.sort_values("bar_ts")
        width = (g["upper"] - g["lower"]).to_numpy()
        assert (np.diff(width) >= -1e-9).all()
        assert (g["lower"] <= g["predicted"]).all() and (g["predicted"] <= g["upper"]).all()


def test_batched_doubling_matches_single():
    rng = np.random.default_rng(5)
    k, n = 7, 40
    A = rng.normal(scale=0.4, size=(n, k, k))
    b = rng.normal(size=(n, k))
    M = b[:, :, None] * b[:, None, :]
    h = rng.integers(1, 300, size=n)
    Pb, Sb = fc.power_and_sum_batched(A, M, h)
    for r in range(n):
        P1, S1 = power_and_sum(A[r], M[r], int(h[r]))
        assert np.allclose(Pb[r], P1, rtol=1e-9, atol=1e-12)
        assert np.allclose(Sb[r], S1, rtol=1e-9, atol=1e-12)


def simulated(rng, n, ar=0.0, ma=0.0, sma=0.0, s=5, burn=200):
    e = rng.normal(size=n + burn)
    w = np.zeros(n + burn)
    for t in range(s + 1, n + burn):
        w[t] = ar * w[t - 1] + e[t] + ma * e[t - 1] + sma * e[t - s] + ma * sma * e[t - s - 1]
    return w[burn:]


def test_seasonal_products_are_recovered(spark):
    rng = np.random.default_rng(3)
    ys = {f"s{i}": 100 + np.cumsum(simulated(rng, 800, 0.5, 0.3, 0.4)) for i in range(50)}
    split = mp.chrono_split(_series_frame(spark, ys), fx.LAYOUTS["daily"], train=1.0, keep_pos=True)
    order = fc.Order(1, 1, 1, 0, 0, 1, 5)
    m = fc.sarima_fit(split, "close", order, layout=fx.LAYOUTS["daily"])[0].toPandas()
    ma = np.array(m["ma"].tolist())
    got = np.r_[np.array(m["ar"].tolist()).mean(axis=0), ma.mean(axis=0)[:2], m["sigma2"].mean()]
    assert order.ma_lags() == [1, 5, 6] and np.abs(got - [0.5, 0.3, 0.4, 1.0]).max() < 0.02
    assert np.allclose(ma[:, 2], ma[:, 0] * ma[:, 1], rtol=1e-12)  # the product constraint
    free = fc.sarima_fit(split, "close", order, layout=fx.LAYOUTS["daily"], steps=0)[0].toPandas()
    both = m.merge(free, on="series")
    assert (both["sigma2_x"] <= both["sigma2_y"] * (1 + 1e-9)).all() and len(m) == 50


def naive_css(theta, w, ok, order):
    """e and its numeric derivatives, one row after the other."""
    shape = css.Shape(order)

    def e_of(p):
        ar, ma = shape.by_lag(np.array(p))
        e = np.zeros(len(w))
        for t in range(len(w)):
            e[t] = w[t] - sum(a * w[t - k] for a, k in zip(ar, order.ar_lags(), strict=True) if t >= k) - sum(
                m * e[t - k] for m, k in zip(ma, order.ma_lags(), strict=True) if t >= k)
        return e * ok
    h = 1e-6
    steps = [np.eye(len(theta))[i] * h for i in range(len(theta))]
    return e_of(theta), np.stack([(e_of(theta + d) - e_of(theta - d)) / (2 * h) for d in steps], axis=1)


def test_blocked_filter_equals_the_plain_recursion(spark):
    """Residuals and cross products by linked blocks of 7 rows, with a hole in the
    data, against a loop over the whole series and numeric derivatives."""
    order = fc.Order(2, 0, 1, 1, 0, 1, 4)
    rng = np.random.default_rng(8)
    y = simulated(rng, 60, 0.4, 0.2, 0.3, 4)
    y[30] = np.nan
    layout = fx.LAYOUTS["daily"]
    split = mp.chrono_split(_series_frame(spark, {"a": y, "b": y[:13]}), layout, train=1.0, keep_pos=True)
    w = fc.seasonal_difference(split.withColumn("y", F.when(~F.isnan("close"), F.col("close"))), "y", order, layout)
    blocks = css.pack(w.select("series", "bar_ts", "_pos", "y", "w"), max(order.ar_lags()), layout, block=7)
    theta = np.array([0.3, -0.1, 0.2, 0.25, -0.4])
    params = spark.createDataFrame([("a", theta.tolist()), ("b", theta.tolist())], "series string, theta array<double>")
    shape = css.Shape(order)
    sums = {r.series: r for r in css._sums(blocks, params, shape, 7).collect()}
    frame = css._with_residuals(blocks, params, shape, 7).toPandas()
    for name, own in (("a", y), ("b", y[:13])):
        ok = np.array([t >= 6 and not np.isnan(own[t - 6: t + 1]).any() for t in range(len(own))])
        e, j = naive_css(theta, np.nan_to_num(own), ok, order)
        x = np.c_[j * ok[:, None], e]
        assert np.allclose(sums[name].cells, (x.T @ x)[np.triu_indices(6)], atol=1e-5) and sums[name].n == ok.sum()
        got = frame[frame.series == name].sort_values("_pos")["e"].to_numpy()
        assert np.allclose(got, e, atol=1e-12)


def test_intervals_cover_what_comes(spark):
    rng = np.random.default_rng(21)
    ys = {f"s{i}": 50 + np.cumsum(simulated(rng, 400, 0.4, 0.2)) for i in range(60)}
    split = mp.chrono_split(_series_frame(spark, ys), fx.LAYOUTS["daily"], train=0.95, keep_pos=True)
    out = fc.sarima_forecast(split, "close", fc.Order(1, 1, 1, 0, 0, 0, 5), layout=fx.LAYOUTS["daily"]).toPandas()
    share = ((out.lower <= out.actual) & (out.actual <= out.upper)).mean()
    assert len(out) == 60 * 20 and 0.88 < share < 0.99  # 95 % intervals, errors of a series go together


def test_log_forecast_is_the_forecast_of_logs(spark):
    rng = np.random.default_rng(2)
    ys = {"a": np.exp(4 + 0.01 * np.cumsum(simulated(rng, 300, 0.3)))}
    layout, order = fx.LAYOUTS["daily"], fc.Order(1, 1, 0, 0, 0, 0, 5)
    split = mp.chrono_split(_series_frame(spark, ys), layout, keep_pos=True)
    a = fc.sarima_forecast(split, "close", order, layout=layout, log=True).toPandas().sort_values("bar_ts")
    logs = split.withColumn("close", F.log("close"))
    b = fc.sarima_forecast(logs, "close", order, layout=layout).toPandas().sort_values("bar_ts")
    for c in ("predicted", "lower", "upper"):
        assert np.allclose(np.log(a[c].to_numpy()), b[c].to_numpy(), rtol=1e-9)
    assert (a["actual"].to_numpy() > 0).all() and len(a) == 60
