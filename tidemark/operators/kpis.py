"""Serving KPIs (K1-K3) and typed result frames.

The "latest row" of a series is a ``max_by(struct, bar_ts)`` aggregation
(partial per task), never a sort of the whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampNTZType

from tidemark.functions.exprs import div
from tidemark.operators import ordered
from tidemark.operators.ordered import HOURLY, Layout

# Result schemas of the scoring path (5 and 19 columns).
RESULT_5 = StructType([
    StructField("Datetime", TimestampNTZType()), StructField("Predicted_Price", DoubleType()),
    StructField("Actual_Price", DoubleType()), StructField("Prediction_Error", DoubleType()),
    StructField("Prediction_Error_Pct", DoubleType())])

RESULT_19 = StructType([
    StructField("Datetime", TimestampNTZType()), StructField("Open", DoubleType()),
    StructField("High", DoubleType()), StructField("Low", DoubleType()),
    StructField("Close", DoubleType()), StructField("Volume", LongType()),
    StructField("Returns", DoubleType()), StructField("Log_Returns", DoubleType()),
    StructField("Price_Range", DoubleType()), StructField("Price_Range_Pct", DoubleType()),
    StructField("SMA_5", DoubleType()), StructField("SMA_20", DoubleType()),
    StructField("EMA_5", DoubleType()), StructField("EMA_20", DoubleType()),
    StructField("RSI", DoubleType()), StructField("Predicted_Price", DoubleType()),
    StructField("Prediction_Time", TimestampNTZType()), StructField("Prediction_Error", DoubleType()),
    StructField("Prediction_Error_Pct", DoubleType())])


def typed_result(df: DataFrame, schema: StructType, mapping: dict[str, str],
                 keep: tuple[str, ...] = ("series",)) -> DataFrame:
    """Select ``mapping[target] = source`` columns cast to ``schema``."""
    return df.select(*keep, *[F.col(mapping.get(f.name, f.name)).cast(f.dataType).alias(f.name)
                              for f in schema.fields])


def latest(df: DataFrame, series: str = "series", ts: str = "bar_ts") -> DataFrame:
    cols = [c for c in df.columns if c != series]
    return (df.groupBy(series).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("_r"))
            .select(series, "_r.*"))


def latest_kpis(scored: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    """K1: latest close, % change vs the previous bar (0 with one bar),
    predicted price, predicted-vs-actual %, RSI."""
    def build(f, w):
        prev = F.lag("close").over(w)
        return f.withColumn("price_change_pct",
                            F.when(prev.isNull(), F.lit(0.0))
                            .otherwise(div(F.col("close") - prev, prev) * 100.0))
    base = scored.select("series", "bar_ts", "close", "predicted_price", "rsi",
                         *[c for c in scored.columns if c == ordered.POS])
    changed = ordered.run_windows(base, build, 1, layout)
    last = latest(changed)
    return last.select("series", "bar_ts", F.col("close").alias("current_price"),
                       "price_change_pct", "predicted_price",
                       (div(F.col("predicted_price") - F.col("close"), F.col("close")) * 100.0)
                       .alias("prediction_diff_pct"), "rsi")


def chart_series(scored: DataFrame) -> DataFrame:
    """K2: the series behind the price, moving-average and volume charts."""
    return scored.select("series", "bar_ts", "close", "predicted_price", "ema_5", "ema_20",
                         "volume")


def latest_prediction(scored: DataFrame) -> DataFrame:
    """K3: latest time, actual, predicted and error % per series."""
    return latest(scored.select("series", "bar_ts", F.col("close").alias("actual_price"),
                                "predicted_price", "prediction_error_pct"))
