"""Registered ML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate as ev
from tidemark.operators import ml
from tidemark.operators import mlprep as mp
from tidemark.functions.exprs import join_on
from tidemark.operators.indicators import technical_features
from tidemark.operators.ordered import series_counts, with_position
from tidemark.plans import fixtures as fx
from tidemark.plans import sqlparts as q
from tidemark.plans import q_eval  # noqa: F401 - its twin is used below
from tidemark.plans.catalog import ORACLE, finish, register
from tidemark.session import materialize, shared_dir
from tidemark.sources.files import write_metrics

SEQ_LEN = 60


def _features(spark, sf):
    return fx.shared(technical_features(fx.bars_hourly(spark, sf)))


def _with_features_sql(body_ctes: str, select: str) -> str:
    from tidemark.plans.q_relations import _with_features
    return _with_features(body_ctes, select)


# M3
@register("assemble", _with_features_sql(
    "u AS (SELECT series, bar_ts, unnest([" + ", ".join(f"{c}::DOUBLE" for c in ml.LR_FEATURES) + "]) AS value, "
    f"unnest(range(0, {len(ml.LR_FEATURES)})) AS i FROM f)", "SELECT series, bar_ts, i::INTEGER AS i, value FROM u"),
    ["value"])
def assemble(spark, sf):
    df = ml.assemble(_features(spark, sf), ml.LR_FEATURES)
    return finish(df.select("series", "bar_ts", F.posexplode(ml.vector_to_array("features")).alias("i", "value")))


def _lr(spark, sf):
    feats = _features(spark, sf)
    # by a hash of the bar's hour: a recomputed task never moves a row between the parts
    hour = F.floor(F.unix_micros(F.col("bar_ts").cast("timestamp")) / 3_600_000_000)
    split = mp.hash_split(feats.withColumn("_hour", hour), "_hour").drop("_hour")
    train, test = (split.filter(F.col("split") == x).drop("split") for x in ("train", "test"))
    cols = ml.nonzero(train, ml.LR_FEATURES)
    return ml.linear_regression(train, cols), train, test


# M7
@register("linear_regression")
def linear_regression(spark, sf):
    model, _, _ = _lr(spark, sf)
    return ml.coefficients(model, spark)


# M8
@register("lr_predict")
def lr_predict(spark, sf):
    model, _, test = _lr(spark, sf)
    return ml.predict(model, test).select("series", "bar_ts", "close", "prediction")


# M9
@register("lr_evaluate")
def lr_evaluate(spark, sf):
    model, _, test = _lr(spark, sf)
    return ml.evaluate(model, test)


# M7-M9 with one feature, whose least squares have a closed form; hours since 2024 of the bars
_ONE = (f"WITH b AS (SELECT *, epoch(bar_ts)::BIGINT // 3600 AS hour FROM ({q.BARS_HOURLY})), "
        f"s AS (SELECT *, CASE WHEN ((hour::HUGEINT * {mp.HASH_MULT} + 42) % {mp.HASH_MOD}) % 100 < 80 THEN 'train' "
        "ELSE 'test' END AS split FROM b), "
        "m AS (SELECT regr_slope(close, open) AS slope, regr_intercept(close, open) AS intercept, "
        "regr_r2(close, open) AS r2 FROM s WHERE split = 'train'), "
        "t AS (SELECT series, bar_ts, close, intercept + slope * open AS prediction FROM s, m WHERE split = 'test') ")


def _lr_one(spark, sf):
    hour = F.floor(F.unix_micros(F.col("bar_ts").cast("timestamp")) / 3_600_000_000)
    split = mp.hash_split(fx.bars_hourly(spark, sf).withColumn("_hour", hour), "_hour").drop("_hour")
    train, test = (split.filter(F.col("split") == x).drop("split") for x in ("train", "test"))
    return ml.linear_regression(train, ["open"], solver="normal"), test


@register("linear_regression_one", _ONE + "SELECT 'open' AS feature, slope AS coefficient FROM m UNION ALL "
          "SELECT 'intercept', intercept FROM m", ["coefficient"])
def linear_regression_one(spark, sf):
    return finish(ml.coefficients(_lr_one(spark, sf)[0], spark))


@register("lr_predict_one", _ONE + "SELECT * FROM t", ["close", "prediction"])
def lr_predict_one(spark, sf):
    model, test = _lr_one(spark, sf)
    return finish(ml.predict(model, test).select("series", "bar_ts", "close", "prediction"))


@register("lr_evaluate_one", _ONE + "SELECT sqrt(avg((close - prediction) ** 2)) AS rmse_test, max(r2) AS r2_train, "
          "1 - sum((close - prediction) ** 2) / (count(*) * var_pop(close)) AS r2_test FROM t, m",
          ["rmse_test", "r2_train", "r2_test"])
def lr_evaluate_one(spark, sf):
    return finish(ml.evaluate(*_lr_one(spark, sf)))


# M5 (window alignment checked exactly: size, first and last element, target)
_F0, _FL = ml.SEQ_FEATURES[0], ml.SEQ_FEATURES[-1]


@register("sequence_windows", _with_features_sql(
    f"rs AS (SELECT series, bar_ts, close, count(*) OVER (PARTITION BY series ORDER BY bar_ts "
    f"ROWS BETWEEN {SEQ_LEN} PRECEDING AND 1 PRECEDING) AS window_rows, "
    f"lag({_F0}, {SEQ_LEN}) OVER (PARTITION BY series ORDER BY bar_ts) AS first_value, "
    f"lag({_FL}, 1) OVER (PARTITION BY series ORDER BY bar_ts) AS last_value FROM f)",
    f"SELECT series, bar_ts, CAST(window_rows * {len(ml.SEQ_FEATURES)} AS INTEGER) AS window_size, "
    f"first_value, last_value, close AS target FROM rs WHERE window_rows = {SEQ_LEN}"),
    ["first_value", "last_value", "target"])
def sequence_windows(spark, sf):
    seq = mp.sequence_windows(_features(spark, sf), ml.SEQ_FEATURES, "close", SEQ_LEN)
    return finish(seq.select("series", "bar_ts", F.size("window").alias("window_size"),
                             F.col("window")[0].alias("first_value"),
                             F.element_at("window", -1).alias("last_value"), "target"))


# M6
@register("sequence_split", f"WITH bars AS ({q.BARS_HOURLY}), c AS (SELECT series, "
          f"count(*) - {SEQ_LEN} AS m FROM bars GROUP BY series) SELECT series, 'train' AS split, "
          "CAST(floor(m * 0.8) AS BIGINT) AS n FROM c UNION ALL SELECT series, 'test' AS split, "
          "CAST(m - floor(m * 0.8) AS BIGINT) AS n FROM c", [])
def sequence_split(spark, sf):
    seq = mp.sequence_windows(_features(spark, sf), ml.SEQ_FEATURES, "close", SEQ_LEN)
    seq = seq.withColumnRenamed("bar_ts", "seq_ts").withColumnRenamed("_pos", "_p0")
    sp = mp.chrono_split(seq.select("series", F.col("seq_ts").alias("bar_ts")))
    return sp.groupBy("series", "split").agg(F.count(F.lit(1)).alias("n"))


def _sequence_rows(spark, sf):
    feats = _features(spark, sf)
    stats = mp.scaler_stats(feats, ["series"], ml.SEQ_FEATURES + ["close"])
    zcols = [f"{c}_z" for c in ml.SEQ_FEATURES]
    scaled = mp.standard_scale(feats, ["series"], ml.SEQ_FEATURES + ["close"], stats, suffix="_z")
    # rows are numbered and split before the windows, which are 60 times as large, are built
    rows = with_position(scaled.select("series", "bar_ts", "close_z", *zcols))
    rows = join_on(rows, series_counts(rows, name="_n"), "series")
    nth, train = F.col("_pos") - SEQ_LEN, F.floor((F.col("_n") - SEQ_LEN) * 0.8)
    part = F.when(nth < F.floor(train * 0.9), "train").when(nth < train, "valid").otherwise("test")
    rows = materialize(rows.withColumn("split", part).drop("_n"))
    return mp.sequence_windows(rows, zcols, "close_z", SEQ_LEN, carry=["split"]), stats


def _sequence_model(spark, sf, fit=ml.sequence_regression):
    seq, stats = _sequence_rows(spark, sf)
    model = fit(*(seq.filter(F.col("split") == x) for x in ("train", "valid")))
    pred = ml.sequence_predict(model, seq).drop("window", "_pos")
    pred = mp.inverse_scale(pred, ["series"], "prediction", stats, "close", "predicted")
    pred = mp.inverse_scale(pred, ["series"], "target", stats, "close", "actual")
    return pred.select("series", "bar_ts", "split", "actual", "predicted")


# M10
@register("sequence_regression")
def sequence_regression(spark, sf):
    pred = _sequence_model(spark, sf)
    return finish(ev.evaluation_report(pred.filter(F.col("split") == "test").drop("split")))


# M10, stopped early
@register("sequence_boosting")
def sequence_boosting(spark, sf):
    pred = _sequence_model(spark, sf, ml.sequence_boosting)
    return finish(ev.evaluation_report(pred.filter(F.col("split") == "test").drop("split")))


# What was saved predicts what the model itself predicts, row by row
@register("model_store", _ONE + "SELECT series, bar_ts, close, prediction, TRUE AS as_fitted FROM t",
          ["close", "prediction"])
def model_store(spark, sf):
    model, test = _lr_one(spark, sf)
    path = shared_dir(spark, "models")
    ml.save_model(model, path, model.stages[0].getInputCols(), spark)
    loaded, _, _ = ml.load_model(path, spark)
    kept = ml.predict(model, test).select("series", "bar_ts", F.col("prediction").alias("_fitted"))
    rows = join_on(ml.predict(loaded, test), kept, ["series", "bar_ts"])
    return finish(rows.select("series", "bar_ts", "close", "prediction",
                              (F.col("prediction") == F.col("_fitted")).alias("as_fitted")))


# S6
@register("metrics_sink", ORACLE["evaluation_report"])
def metrics_sink(spark, sf):
    from tidemark.plans.q_eval import forecast_frame
    report = ev.evaluation_report(forecast_frame(spark, sf))
    path = shared_dir(spark, "metrics")
    write_metrics(report, path)
    return finish(spark.read.parquet(path).drop("run_ts"))
