"""Registered streaming queries (S4, T1-T7): each replays the given ticks as a
bounded stream (``availableNow``) and returns the sink's table; batch equality is
checked against the SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate as ev
from tidemark.operators import kpis as kp
from tidemark.operators import ml
from tidemark.operators.forecast import seasonal_naive_ahead, seasonal_naive_one_step
from tidemark.operators.indicators import realtime_features, technical_features
from tidemark.operators.ordered import with_position
from tidemark.plans import fixtures as fx
from tidemark.plans import sqlparts as q
from tidemark.plans.catalog import ORACLE, finish, register
from tidemark.plans.q_eval import latest_kpis  # noqa: F401 - its twin is used below
from tidemark.session import shared_dir
from tidemark.streaming import jobs

BD = ["open", "high", "low", "close"]
W = q.w()


def _events(sf):
    # a pattern, as the file stream takes a plain path for a folder and the table may be one file
    return f"{sf.rstrip('/')}/events.parque[t]"


def _bars_stream(spark, sf):
    """Hourly bars that the T1 job makes of the ticks, as a stream."""
    path = jobs.bars_job(spark, _events(sf), shared_dir(spark, "streams", "bars"))
    return jobs.stream_source(spark, path, jobs.BAR_SCHEMA)


def _in_runs(spark, sf, step, runs=3):
    """Land the ticks in ``runs`` parts by time, each with the last 30 minutes of
    the part before once more, and run T1 and then ``step(path)`` after each, on
    the same roots.  Returns what the last step returned."""
    events = spark.read.schema(jobs.TICK_SCHEMA).parquet(_events(sf))
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    root, out = shared_dir(spark, "streams", "runs"), None
    for i in range(runs):
        cuts = [span["a"] + (span["b"] - span["a"]) * k / runs for k in (i, i + 1)]
        part = events.where(F.col("ts") >= F.lit(cuts[0]) - F.expr("INTERVAL 30 MINUTES"))
        if i + 1 < runs:
            part = part.where(F.col("ts") < F.lit(cuts[1]))
        part.write.parquet(f"{root}/ticks/{i}")
        out = step(jobs.bars_job(spark, f"{root}/ticks/*", f"{root}/t1", once=True), f"{root}/next")
    return out


# S4
@register("stream_bars", "SELECT * FROM events", ["value"])
def stream_bars(spark, sf):
    _, out = jobs.run(jobs.stream_source(spark, _events(sf)), shared_dir(spark, "streams", "s4"))
    return finish(spark.read.schema(jobs.TICK_SCHEMA).parquet(out))


# Closed windows from the stream, the last open ones from the flush
@register("stream_ohlc_tumbling", q.BARS_HOURLY, BD)
def stream_ohlc_tumbling(spark, sf):
    path = jobs.bars_job(spark, _events(sf), shared_dir(spark, "streams", "t1"))
    return finish(spark.read.schema(jobs.BAR_SCHEMA).parquet(path))


# T1 started three times on one root, with ticks delivered again
@register("stream_ohlc_restarted", q.BARS_HOURLY, BD)
def stream_ohlc_restarted(spark, sf):
    return finish(spark.read.schema(jobs.BAR_SCHEMA).parquet(_in_runs(spark, sf, lambda path, _: path)))


# Every tick delivered twice, kept once
@register("stream_dedup", "SELECT * FROM events", ["value"])
def stream_dedup(spark, sf):
    twice = jobs.stream_source(spark, _events(sf)).unionByName(jobs.stream_source(spark, _events(sf)))
    _, out = jobs.run(jobs.dedup(twice), shared_dir(spark, "streams", "t2"))
    return finish(spark.read.parquet(out))


# T3
def _rt_sql() -> str:
    from tidemark.plans.q_indicators import _realtime_sql
    return _realtime_sql(False)


@register("stream_indicators_batch", _rt_sql(),
          BD + ["returns", "log_returns", "price_range", "price_range_pct", "sma_5", "sma_20",
                "ema_5", "ema_20", "rsi"])
def stream_indicators_batch(spark, sf):
    job = _in_runs(spark, sf, lambda path, root: jobs.indicators_per_batch(
        jobs.stream_source(spark, path, jobs.BAR_SCHEMA), root))
    return finish(job.result(spark))


# T4
_T4 = q.with_bars(
    "SELECT g.series, g.bar_ts, g.close, avg(g.close) " + q.w(5).replace("series", "g.series")
    .replace("bar_ts", "g.bar_ts") + " AS sma_5, avg(g.close) " + q.w(20).replace(
        "series", "g.series").replace("bar_ts", "g.bar_ts") + " AS sma_20, r.ema_5, r.ema_20, "
    "CASE WHEN (CASE WHEN avg(loss) OVER w14 <> 0 THEN avg(gain) OVER w14 / avg(loss) OVER w14 "
    "ELSE 0 END) <> 0 THEN 100 - 100 / (1 + avg(gain) OVER w14 / avg(loss) OVER w14) ELSE 0 END "
    "AS rsi FROM g JOIN r ON r.series = g.series AND r.pos = g.pos WINDOW w14 AS (PARTITION BY "
    "g.series ORDER BY g.bar_ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)",
    q.BARS_HOURLY,
    "d AS (SELECT *, close - lag(close) " + W + " AS delta FROM b), "
    "g AS (SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0 END AS gain, "
    "CASE WHEN delta < 0 THEN -delta ELSE 0 END AS loss FROM d), " +
    q.ema_recursive("b", [("close", 5, "ema_5"), ("close", 20, "ema_20")], []),
).replace("WITH bars AS", "WITH RECURSIVE bars AS")


@register("stream_indicators_state", _T4, ["close", "sma_5", "sma_20", "ema_5", "ema_20", "rsi"])
def stream_indicators_state(spark, sf):
    job = jobs.indicators_with_state(_bars_stream(spark, sf), shared_dir(spark, "streams", "t4"))
    return finish(job.result(spark).unionByName(job.open(spark)))


# T5: the stream's predictions are the batch's, row by row
@register("stream_score", f"SELECT series, bar_ts, close, TRUE AS as_batch FROM ({q.BARS_HOURLY})", ["close"])
def stream_score(spark, sf):
    stream, batch = scored_both_ways(spark, sf)
    both = stream.join(batch.select("series", "bar_ts", F.col("prediction").alias("_batch")), ["series", "bar_ts"], "left")
    return finish(both.select("series", "bar_ts", "close", F.col("prediction").eqNullSafe(F.col("_batch")).alias("as_batch")))


def scored_both_ways(spark, sf):
    """(predictions of the stream, of the batch) by one saved model."""
    from tidemark.operators import mlprep as mp
    feats = technical_features(fx.bars_hourly(spark, sf))
    train = mp.hash_split(feats.withColumn("_k", F.year("bar_ts") * 366 + F.dayofyear("bar_ts")), "_k").filter(
        F.col("split") == "train").drop("split", "_k")
    model = ml.linear_regression(train, ml.nonzero(train, ml.LR_FEATURES))
    path = shared_dir(spark, "models", "t5")
    ml.save_model(model, path, model.stages[0].getInputCols(), spark)
    landing = shared_dir(spark, "landing", "features")
    feats.write.parquet(landing)
    loaded, _, _ = ml.load_model(path, spark)
    stream = spark.readStream.schema(feats.schema).option("maxFilesPerTrigger", 2).parquet(landing)
    _, out = jobs.run(ml.predict(loaded, stream).select("series", "bar_ts", "close", "prediction"),
                      shared_dir(spark, "streams", "t5"))
    batch = ml.predict(loaded, spark.read.schema(feats.schema).parquet(landing))
    return spark.read.parquet(out), batch


# T5 with K3: predictions meet the prices that come later
_AHEAD = (f"WITH b AS ({q.BARS_HOURLY}), "
          f"p AS (SELECT series, bar_ts AS made_ts, bar_ts + INTERVAL 1 HOUR AS target_ts, close + lag(close, 4) {W} - "
          f"lag(close, 5) {W} AS predicted_price FROM b), "
          "j AS (SELECT p.*, b.bar_ts, b.close AS actual_price FROM p LEFT JOIN b ON b.series = p.series AND "
          "b.bar_ts = p.target_ts WHERE predicted_price IS NOT NULL), "
          "e AS (SELECT max(bar_ts) - INTERVAL 10 MINUTE AS passed FROM b) ")


@register("stream_prediction_errors", _AHEAD + "SELECT series, made_ts, target_ts, predicted_price, bar_ts, actual_price, "
          "abs(predicted_price - actual_price) / NULLIF(actual_price, 0) * 100 AS prediction_error_pct FROM j, e "
          "WHERE bar_ts IS NOT NULL OR target_ts + INTERVAL 59 MINUTE < passed",
          ["predicted_price", "actual_price", "prediction_error_pct"])
def stream_prediction_errors(spark, sf):
    bars = fx.bars_hourly(spark, sf)
    w = seasonal_naive_ahead(bars)
    made, prices = shared_dir(spark, "landing", "made"), shared_dir(spark, "landing", "prices")
    w.write.parquet(made)
    bars.write.parquet(prices)
    joined = jobs.match_predictions(
        spark.readStream.schema(w.schema).parquet(made), jobs.stream_source(spark, prices, jobs.BAR_SCHEMA), "59 minutes")
    _, out = jobs.run(joined, shared_dir(spark, "streams", "met"))
    return finish(spark.read.schema(joined.schema).parquet(out))


# T6
@register("stream_trigger", "SELECT count(*) AS input_rows FROM events")
def stream_trigger(spark, sf):
    counts = jobs.count_input(jobs.stream_source(spark, _events(sf)), shared_dir(spark, "streams", "t6"))
    return counts.agg(F.sum("num_input_rows").alias("input_rows"))


# T7
def _score(bars):
    priced = seasonal_naive_one_step(realtime_features(with_position(bars)), out="predicted_price")
    return ev.prediction_errors(priced, "close", "predicted_price")


def _kpis(spark, sf, kpi):
    job = _in_runs(spark, sf, lambda path, root: jobs.kpis_per_batch(
        jobs.stream_source(spark, path, jobs.BAR_SCHEMA), root, _score, kpi=kpi))
    return finish(job.result(spark))


@register("stream_kpis", ORACLE["latest_kpis"])
def stream_kpis(spark, sf):
    return _kpis(spark, sf, kp.latest_kpis)


# T7 with K3
@register("stream_latest_prediction", ORACLE["latest_prediction"])
def stream_latest_prediction(spark, sf):
    return _kpis(spark, sf, kp.latest_prediction)
