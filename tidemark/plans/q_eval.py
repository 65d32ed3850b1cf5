"""Registered evaluation, split, scaling and KPI queries
(E1-E9, W24, W25, M1, M2, M4, M11, K1-K3, S7).

Predictions come from a deterministic model both engines can compute: the
one-step (0,1,0)(0,1,0,5) seasonal-naive forecast of the hourly close.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate as ev
from tidemark.operators import kpis as kp
from tidemark.operators import mlprep as mp
from tidemark.operators.forecast import seasonal_naive_one_step
from tidemark.operators.indicators import realtime_features
from tidemark.operators.ordered import with_position
from tidemark.plans import fixtures as fx
from tidemark.plans import sqlparts as q
from tidemark.plans.catalog import finish, register

W = q.w()
BD = ["open", "high", "low", "close"]

FC_CTE = (f"fc AS (SELECT * FROM (SELECT series, bar_ts, close AS actual, lag(close, 1) {W} + "
          f"lag(close, 5) {W} - lag(close, 6) {W} AS predicted FROM bars) "
          "WHERE predicted IS NOT NULL)")
DIR_CTE = (f"mv AS (SELECT *, actual / NULLIF(lag(actual) {W}, 0) - 1 AS ma, "
           f"predicted / NULLIF(lag(predicted) {W}, 0) - 1 AS mp FROM fc), "
           "dr AS (SELECT *, CAST(sign(ma) AS INTEGER) AS da, CAST(sign(mp) AS INTEGER) AS dp "
           "FROM mv WHERE ma IS NOT NULL AND mp IS NOT NULL)")


def _fc_sql(body: str, more: str = "") -> str:
    extra = f", {more}" if more else ""
    return f"WITH bars AS ({q.BARS_HOURLY}), {FC_CTE}{extra} {body}"


def forecast_frame(spark, sf):
    """(series, bar_ts, actual, predicted) with the one-step seasonal naive."""
    b = seasonal_naive_one_step(fx.bars_hourly(spark, sf))
    return fx.shared(b.select("series", "bar_ts", F.col("close").alias("actual"), "predicted")
                     .filter(F.col("predicted").isNotNull()))


def _dirs(spark, sf):
    return fx.shared(ev.direction_frame(forecast_frame(spark, sf)))


# E9
@register("align_actual_predicted", _fc_sql("SELECT bars.series, bars.bar_ts, bars.close, "
          "fc.predicted FROM bars JOIN fc USING (series, bar_ts)"), ["close", "predicted"])
def align_actual_predicted(spark, sf):
    bars = fx.bars_hourly(spark, sf).select("series", "bar_ts", "close")
    pred = forecast_frame(spark, sf).select("series", "bar_ts", "predicted")
    return finish(ev.align(bars, pred))


# E9 by position: 60 rows are skipped, as a window model's first; the longer side is trimmed
@register("align_by_position", _fc_sql(
    f"SELECT a.series, a.bar_ts, a.close, p.predicted FROM (SELECT *, row_number() {W} - 60 AS n FROM bars) a "
    f"JOIN (SELECT *, row_number() {W} AS n FROM fc) p ON p.series = a.series AND p.n = a.n"), ["close", "predicted"])
def align_by_position(spark, sf):
    bars = fx.bars_hourly(spark, sf).select("series", "bar_ts", "close")
    pred = forecast_frame(spark, sf).select("series", "bar_ts", "predicted")
    return finish(ev.align_by_position(bars, pred, skip=60))


# E1
_E1 = ("SELECT series, count(*) AS n, avg((actual - predicted) * (actual - predicted)) AS mse, "
       "sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse, "
       "avg(abs(actual - predicted)) AS mae, "
       "avg(abs((actual - predicted) / NULLIF(actual, 0))) * 100 AS mape, "
       "1 - sum((actual - predicted) * (actual - predicted)) / NULLIF(var_pop(actual) * count(*), 0) "
       "AS r2 FROM fc GROUP BY series")


@register("regression_metrics", _fc_sql(_E1), ["mse", "rmse", "mae", "mape", "r2"])
def regression_metrics(spark, sf):
    return finish(ev.regression_metrics(forecast_frame(spark, sf)))


# E2
_E2 = (f"SELECT series, count(*) AS comparisons, avg(CASE WHEN sign(da) = sign(dq) THEN 1.0 ELSE "
       f"0.0 END) * 100 AS directional_accuracy FROM (SELECT series, actual - lag(actual) {W} AS da, "
       f"predicted - lag(predicted) {W} AS dq FROM fc) WHERE da IS NOT NULL AND dq IS NOT NULL "
       "GROUP BY series")


@register("directional_accuracy_diff", _fc_sql(_E2), ["directional_accuracy"])
def directional_accuracy_diff(spark, sf):
    return finish(ev.directional_accuracy_diff(forecast_frame(spark, sf)))


# E3
@register("directional_metrics", _fc_sql(
    "SELECT series, avg(CASE WHEN da = dp THEN 1.0 ELSE 0.0 END) * 100 AS overall_accuracy, "
    "coalesce(avg(CASE WHEN da > 0 THEN (CASE WHEN da = dp THEN 1.0 ELSE 0.0 END) END) * 100, 0) "
    "AS up_accuracy, coalesce(avg(CASE WHEN da < 0 THEN (CASE WHEN da = dp THEN 1.0 ELSE 0.0 END) "
    "END) * 100, 0) AS down_accuracy FROM dr GROUP BY series", DIR_CTE),
    ["overall_accuracy", "up_accuracy", "down_accuracy"])
def directional_metrics(spark, sf):
    return finish(ev.directional_metrics(_dirs(spark, sf)))


# E4
@register("confusion_counts", _fc_sql(
    "SELECT series, CASE WHEN da > 0 THEN 'up' ELSE 'down' END AS actual_direction, "
    "CASE WHEN dp > 0 THEN 'up' ELSE 'down' END AS predicted_direction, count(*) AS n FROM dr "
    "WHERE da <> 0 AND dp <> 0 GROUP BY ALL", DIR_CTE), [])
def confusion_counts(spark, sf):
    return finish(ev.confusion_counts(_dirs(spark, sf)))


# E5
@register("precision_recall_f1", _fc_sql(
    "SELECT series, tp, tn, fp, fn, prec * 100 AS precision, rec * 100 AS recall, "
    "coalesce(2 * prec * rec / NULLIF(prec + rec, 0), 0) * 100 AS f1 FROM (SELECT *, "
    "coalesce(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0) AS prec, "
    "coalesce(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0) AS rec FROM (SELECT series, "
    "count(*) FILTER (WHERE da > 0 AND dp > 0) AS tp, count(*) FILTER (WHERE da < 0 AND dp < 0) "
    "AS tn, count(*) FILTER (WHERE da < 0 AND dp > 0) AS fp, count(*) FILTER (WHERE da > 0 AND "
    "dp < 0) AS fn FROM dr GROUP BY series))", DIR_CTE), ["precision", "recall", "f1"])
def precision_recall_f1(spark, sf):
    return finish(ev.precision_recall_f1(_dirs(spark, sf)))


# E6
_E6 = ("SELECT series, count(*) AS n, min(actual) AS actual_min, max(actual) AS actual_max, "
       "min(predicted) AS predicted_min, max(predicted) AS predicted_max, "
       "stddev_pop(actual - predicted) AS error_std, avg(actual - predicted) AS error_mean, "
       "quantile_cont(actual - predicted, 0.5) AS error_median FROM fc GROUP BY series")
_E6_D = ["actual_min", "actual_max", "predicted_min", "predicted_max", "error_std", "error_mean",
         "error_median"]


@register("error_summary", _fc_sql(_E6), _E6_D)
def error_summary(spark, sf):
    return finish(ev.error_summary(forecast_frame(spark, sf)))


# E7
@register("residuals", _fc_sql("SELECT series, bar_ts, actual - predicted AS residual FROM fc"),
          ["residual"])
def residuals(spark, sf):
    return finish(ev.residuals(forecast_frame(spark, sf)))


# E8
@register("evaluation_report", _fc_sql(
    f"SELECT * FROM ({_E1}) JOIN ({_E2}) USING (series) JOIN ({_E6.replace('count(*) AS n, ', '')}) "
    "USING (series)"),
    ["mse", "rmse", "mae", "mape", "r2", "directional_accuracy"] + _E6_D)
def evaluation_report(spark, sf):
    return finish(ev.evaluation_report(forecast_frame(spark, sf)))


# W24
@register("rolling_accuracy", _fc_sql(
    "SELECT series, bar_ts, CASE WHEN count(h) OVER w20 = 20 THEN avg(h) OVER w20 * 100 END AS "
    "rolling_accuracy FROM (SELECT *, CASE WHEN da = dp THEN 1.0 ELSE 0.0 END AS h FROM dr) "
    "WINDOW w20 AS (PARTITION BY series ORDER BY bar_ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)",
    DIR_CTE), ["rolling_accuracy"])
def rolling_accuracy(spark, sf):
    return finish(ev.rolling_accuracy(_dirs(spark, sf)))


# W25
@register("cumulative_return", _fc_sql(
    "SELECT series, bar_ts, product(1 + ma) OVER wc AS cum_actual, product(1 + mp) OVER wc AS "
    "cum_predicted FROM dr WINDOW wc AS (PARTITION BY series ORDER BY bar_ts ROWS BETWEEN "
    "UNBOUNDED PRECEDING AND CURRENT ROW)", DIR_CTE), ["cum_actual", "cum_predicted"])
def cumulative_return(spark, sf):
    return finish(ev.cumulative_return(_dirs(spark, sf)))


# M11
@register("prediction_errors", _fc_sql(
    "SELECT *, abs(predicted - actual) AS prediction_error, abs(predicted - actual) / "
    "NULLIF(actual, 0) * 100 AS prediction_error_pct FROM fc"),
    ["actual", "predicted", "prediction_error", "prediction_error_pct"])
def prediction_errors(spark, sf):
    return finish(ev.prediction_errors(forecast_frame(spark, sf)))


# M1
@register("chrono_split", f"SELECT *, CASE WHEN row_number() {W} - 1 < floor(count(*) OVER "
          f"(PARTITION BY series) * 0.8) THEN 'train' ELSE 'test' END AS split FROM ({q.BARS_HOURLY})",
          BD)
def chrono_split(spark, sf):
    return finish(mp.chrono_split(fx.bars_hourly(spark, sf)))


# M2
@register("hash_split", f"SELECT event_id, event_type, value, CASE WHEN ((event_id::HUGEINT * "
          f"{mp.HASH_MULT} + 42) % {mp.HASH_MOD}) % 100 < 80 THEN 'train' ELSE 'test' END AS split "
          "FROM events", ["value"])
def hash_split(spark, sf):
    e = fx.table(spark, sf, "events").select("event_id", "event_type", "value")
    return finish(mp.hash_split(e, "event_id"))


@register("random_split")
def random_split(spark, sf):
    """M2 with MLlib's randomSplit (seed 42): train part, rows-only check."""
    train, _ = mp.random_split(fx.table(spark, sf, "events"))
    return finish(train)


# M4
_SC = ["close", "volume"]


@register("standard_scale", f"WITH bars AS ({q.BARS_HOURLY}), st AS (SELECT series, "
          + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _SC)
          + " FROM bars GROUP BY series) SELECT bars.*, "
          + ", ".join(f"coalesce(({c} - {c}_m) / NULLIF({c}_s, 0), {c} - {c}_m) AS {c}_scaled"
                      for c in _SC) + " FROM bars JOIN st USING (series)",
          BD + [f"{c}_scaled" for c in _SC])
def standard_scale(spark, sf):
    return finish(mp.standard_scale(fx.bars_hourly(spark, sf), ["series"], _SC))


# ------------------------------------------------------------------ KPIs

def scored_bars(spark, sf):
    """Real-time features + one-step seasonal-naive price + errors."""
    numbered = with_position(fx.bars_hourly(spark, sf))  # once for all that follows
    b = seasonal_naive_one_step(realtime_features(numbered), out="predicted_price")
    return fx.shared(ev.prediction_errors(b, "close", "predicted_price"))


def _scored_sql(body: str) -> str:
    from tidemark.plans.q_indicators import _realtime_sql
    head, _, rest = _realtime_sql(False).partition("\nSELECT series, bar_ts")
    sc = (f"sc AS (SELECT *, abs(predicted_price - close) AS prediction_error, "
          "abs(predicted_price - close) / NULLIF(close, 0) * 100 AS prediction_error_pct FROM "
          f"(SELECT *, lag(close, 1) {W} + lag(close, 5) {W} - lag(close, 6) {W} AS predicted_price "
          "FROM rtf))")
    return f"{head},\nrtf AS (SELECT series, bar_ts{rest}),\n{sc}\n{body}"


# K1
@register("latest_kpis", _scored_sql(
    f"SELECT series, bar_ts, close AS current_price, CASE WHEN lag(close) {W} IS NULL THEN 0 ELSE "
    f"(close - lag(close) {W}) / NULLIF(lag(close) {W}, 0) * 100 END AS price_change_pct, "
    "predicted_price, (predicted_price - close) / NULLIF(close, 0) * 100 AS prediction_diff_pct, "
    "rsi FROM sc QUALIFY row_number() OVER (PARTITION BY series ORDER BY bar_ts DESC) = 1"),
    ["current_price", "price_change_pct", "predicted_price", "prediction_diff_pct", "rsi"])
def latest_kpis(spark, sf):
    return finish(kp.latest_kpis(scored_bars(spark, sf)))


# K2
@register("chart_series", _scored_sql(
    "SELECT series, bar_ts, close, predicted_price, ema_5, ema_20, volume FROM sc"),
    ["close", "predicted_price", "ema_5", "ema_20"])
def chart_series(spark, sf):
    return finish(kp.chart_series(scored_bars(spark, sf)))


# K3
@register("latest_prediction", _scored_sql(
    "SELECT series, bar_ts, close AS actual_price, predicted_price, prediction_error_pct FROM sc "
    "QUALIFY row_number() OVER (PARTITION BY series ORDER BY bar_ts DESC) = 1"),
    ["actual_price", "predicted_price", "prediction_error_pct"])
def latest_prediction(spark, sf):
    return finish(kp.latest_prediction(scored_bars(spark, sf)))


# S7
_R5 = ["Predicted_Price", "Actual_Price", "Prediction_Error", "Prediction_Error_Pct"]


@register("typed_result", _scored_sql(
    "SELECT series, bar_ts AS \"Datetime\", predicted_price AS \"Predicted_Price\", close AS "
    "\"Actual_Price\", prediction_error AS \"Prediction_Error\", prediction_error_pct AS "
    "\"Prediction_Error_Pct\" FROM sc"), _R5)
def typed_result(spark, sf):
    return finish(kp.typed_result(scored_bars(spark, sf), kp.RESULT_5, {
        "Datetime": "bar_ts", "Predicted_Price": "predicted_price", "Actual_Price": "close",
        "Prediction_Error": "prediction_error", "Prediction_Error_Pct": "prediction_error_pct"}))


# S7, all 19 columns; a prediction is made for the hour after its bar
_R19 = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Volume": "volume", "Returns": "returns",
        "Log_Returns": "log_returns", "Price_Range": "price_range", "Price_Range_Pct": "price_range_pct",
        "SMA_5": "sma_5", "SMA_20": "sma_20", "EMA_5": "ema_5", "EMA_20": "ema_20", "RSI": "rsi",
        "Predicted_Price": "predicted_price", "Prediction_Error": "prediction_error",
        "Prediction_Error_Pct": "prediction_error_pct"}


@register("typed_result_19", _scored_sql(
    "SELECT series, bar_ts AS \"Datetime\", bar_ts + INTERVAL 1 HOUR AS \"Prediction_Time\", "
    + ", ".join(f"{v} AS \"{k}\"" for k, v in _R19.items()) + " FROM sc"), [k for k in _R19 if k != "Volume"])
def typed_result_19(spark, sf):
    rows = scored_bars(spark, sf).withColumn("next_ts", F.expr("bar_ts + INTERVAL 1 HOUR"))
    return finish(kp.typed_result(rows, kp.RESULT_19, {**_R19, "Datetime": "bar_ts", "Prediction_Time": "next_ts"}))
