"""Registered forecasting queries (F1-F7) on the hourly event bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import forecast as fc
from tidemark.operators import mlprep as mp
from tidemark.plans import fixtures as fx
from tidemark.plans import sqlparts as q
from tidemark.plans.catalog import finish, register

W = q.w()
BD = ["open", "high", "low", "close"]
_DIFF = (f"close + (-1.0) * lag(close, 1) {W} + (-1.0) * lag(close, 5) {W} + "
         f"1.0 * lag(close, 6) {W}")


def _split(spark, sf):
    return mp.chrono_split(fx.bars_hourly(spark, sf), keep_pos=True)


# F1
@register("seasonal_difference", f"SELECT *, {_DIFF} AS w FROM ({q.BARS_HOURLY})", BD + ["w"])
def seasonal_difference(spark, sf):
    return finish(fc.seasonal_difference(fx.bars_hourly(spark, sf)))


# F2
_LAGS = fc.ORDER_B.ar_lags()


@register("lag_design", f"SELECT series, bar_ts, w, " + ", ".join(
    f"lag(w, {k}) {W} AS lag_{k}" for k in _LAGS) +
    f" FROM (SELECT series, bar_ts, {_DIFF} AS w FROM ({q.BARS_HOURLY}))",
    ["w"] + [f"lag_{k}" for k in _LAGS])
def lag_design(spark, sf):
    w = fc.seasonal_difference(fx.bars_hourly(spark, sf)).select("series", "bar_ts", "w")
    return finish(fc.lag_design(w, "w", _LAGS))


# F3 with one AR lag: its conditional sum of squares has a closed form
@register("sarima_fit_ar1",
          f"WITH bars AS ({q.BARS_HOURLY}), "
          f"sp AS (SELECT *, row_number() {W} <= floor(count(*) OVER (PARTITION BY series) * 0.8) AS is_train FROM bars), "
          f"d AS (SELECT series, bar_ts, close - lag(close) {W} AS w FROM sp WHERE is_train), "
          f"l AS (SELECT series, w, lag(w) {W} AS x FROM d), "
          "c AS (SELECT series, sum(w * x) / sum(x * x) AS phi, sum(w * w) AS ww, sum(w * x) AS wx, sum(x * x) AS xx, "
          "count(*) AS n FROM l WHERE x IS NOT NULL GROUP BY series) "
          "SELECT series, phi, (ww - 2 * phi * wx + phi * phi * xx) / n AS sigma2, n FROM c", ["phi", "sigma2"])
def sarima_fit_ar1(spark, sf):
    model, _ = fc.sarima_fit(_split(spark, sf), "close", fc.Order(1, 1, 0, 0, 0, 0, 5))
    return finish(model.select("series", F.col("ar")[0].alias("phi"), "sigma2", "n"))


# F3 (least-squares estimates: rows-only + recovery tests)
@register("sarima_fit")
def sarima_fit(spark, sf):
    model, _ = fc.sarima_fit(_split(spark, sf), "close", fc.ORDER_B)
    return model


# F4
@register("sarima_forecast")
def sarima_forecast(spark, sf):
    return finish(fc.sarima_forecast(_split(spark, sf), "close", fc.ORDER_A)
                  .select("series", "bar_ts", "actual", "predicted"))


# F5
@register("forecast_interval")
def forecast_interval(spark, sf):
    return finish(fc.sarima_forecast(_split(spark, sf), "close", fc.ORDER_A))


# F6
@register("log_forecast")
def log_forecast(spark, sf):
    return finish(fc.sarima_forecast(_split(spark, sf), "close", fc.ORDER_B, log=True))


# F7
_F7 = (f"WITH bars AS ({q.BARS_HOURLY}), "
       f"sp AS (SELECT *, row_number() {W} - 1 AS pos, row_number() {W} - 1 < "
       "floor(count(*) OVER (PARTITION BY series) * 0.8) AS is_train FROM bars), "
       "te AS (SELECT series, max(pos) AS t FROM sp WHERE is_train GROUP BY series), "
       "st AS (SELECT series, t, " + ", ".join(
           f"max(CASE WHEN pos = t - {k} THEN close END) AS y{k}" for k in range(6)) +
       " FROM sp JOIN te USING (series) GROUP BY series, t) "
       "SELECT sp.series, sp.bar_ts, sp.close AS actual, (CASE ((sp.pos - st.t - 1) % 5) + 1 " +
       " ".join(f"WHEN {r} THEN y{5 - r}" for r in range(1, 6)) +
       " END) + CAST(floor((sp.pos - st.t - 1) / 5) + 1 AS DOUBLE) * (y0 - y5) AS predicted "
       "FROM sp JOIN st USING (series) WHERE NOT sp.is_train")


@register("seasonal_naive", _F7, ["actual", "predicted"])
def seasonal_naive(spark, sf):
    return finish(fc.seasonal_naive_forecast(_split(spark, sf)))


# F4, F5 and F6 of order (0,1,0)(0,1,0,5): all coefficients of its forecasts are known
def _naive_sql(value: str, back: str) -> str:
    """Forecast and interval of ``value`` by the closed form (see F7): the sum of
    squared psi weights floor(j / 5) + 1, j < h, times the variance of w."""
    return (_F7.partition("SELECT sp.series, sp.bar_ts")[0].replace(
        f"WITH bars AS ({q.BARS_HOURLY})",
        f"WITH raw AS ({q.BARS_HOURLY}), bars AS (SELECT series, bar_ts, close AS price, {value} AS close FROM raw)") +
        f", w AS (SELECT series, is_train, {_DIFF} AS w FROM sp), "
        "sg AS (SELECT series, avg(w * w) AS sigma2 FROM w WHERE is_train AND w IS NOT NULL GROUP BY series), "
        "f AS (SELECT sp.series, sp.bar_ts, sp.price AS actual, sigma2, sp.pos - st.t AS h, (CASE ((sp.pos - st.t - 1) % 5) "
        "+ 1 " + " ".join(f"WHEN {r} THEN y{5 - r}" for r in range(1, 6)) +
        " END) + CAST(floor((sp.pos - st.t - 1) / 5) + 1 AS DOUBLE) * (y0 - y5) AS point FROM sp JOIN st USING (series) "
        "JOIN sg USING (series) WHERE NOT sp.is_train), "
        "g AS (SELECT *, 1.959963984540054 * sqrt(sigma2 * list_sum(list_transform(range(0, h), "
        "lambda j: (floor(j / 5) + 1) * (floor(j / 5) + 1)))) AS half FROM f) "
        f"SELECT series, bar_ts, actual, {back}(point) AS predicted, {back}(point - half) AS lower, "
        f"{back}(point + half) AS upper FROM g")


_BAND = ["actual", "predicted", "lower", "upper"]
_NAIVE = fc.Order(0, 1, 0, 0, 1, 0, 5)


@register("sarima_forecast_naive", f"SELECT series, bar_ts, actual, predicted FROM ({_naive_sql('close', '')})", _BAND[:2])
def sarima_forecast_naive(spark, sf):
    return finish(fc.sarima_forecast(_split(spark, sf), "close", _NAIVE).select("series", "bar_ts", "actual", "predicted"))


@register("forecast_interval_naive", _naive_sql("close", ""), _BAND)
def forecast_interval_naive(spark, sf):
    return finish(fc.sarima_forecast(_split(spark, sf), "close", _NAIVE))


# compared as logarithms, where the bounds are in a double's range
@register("log_forecast_naive", "SELECT series, bar_ts, actual, " + ", ".join(
    f"CASE WHEN {c} > 1e-300 AND {c} < 1e300 THEN ln({c}) END AS log_{c}" for c in _BAND[1:]) +
    f" FROM ({_naive_sql('ln(close)', 'exp')})", ["actual", *[f"log_{c}" for c in _BAND[1:]]])
def log_forecast_naive(spark, sf):
    out = fc.sarima_forecast(_split(spark, sf), "close", _NAIVE, log=True)
    return finish(out.select("series", "bar_ts", "actual", *[
        F.when((F.col(c) > 1e-300) & (F.col(c) < 1e300), F.log(c)).alias(f"log_{c}") for c in _BAND[1:]]))
