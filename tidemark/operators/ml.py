"""Spark ML models (M3, M7-M10) — MLlib estimators on DataFrames.

Training is MLlib's distributed optimisation (normal equations / L-BFGS over
``treeAggregate``); scoring is ``model.transform`` on batch or streaming
frames, never a driver-side predict.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The regression features of the linear model (our names).
LR_FEATURES = ["open", "high", "low", "volume", "returns", "log_returns", "price_range",
               "price_range_pct", "sma_5", "sma_20", "ema_5", "ema_20", "rsi"]
# The 18 inputs of the sequence model (our names).
SEQ_FEATURES = ["returns", "log_returns", "price_range_pct", "sma_5", "sma_20", "ema_5", "ema_20",
                "rsi", "bb_upper", "bb_lower", "k_line", "d_line", "volume_sma_5", "volume_ratio",
                "macd", "macd_signal", "daily_volatility", "atr"]


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """M3."""
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def nonzero(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """P12 decision: the columns whose sum is not 0 (one aggregation job)."""
    row = df.agg(*[F.sum(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] not in (0, 0.0, None)]


def linear_regression(train: DataFrame, features: Sequence[str], label: str = "close",
                      **params) -> PipelineModel:
    """M7: assembler + linear regression as one pipeline."""
    lr = LinearRegression(featuresCol="features", labelCol=label, **params)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"),
                            lr]).fit(train)


def coefficients(model: PipelineModel, spark) -> DataFrame:
    """Fitted coefficients as rows (feature, coefficient) incl. the intercept."""
    asm, lr = model.stages[0], model.stages[-1]
    rows = list(zip(asm.getInputCols(), [float(v) for v in lr.coefficients]))
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M8: works on batch and streaming DataFrames."""
    return model.transform(df).drop("features")


def evaluate(model: PipelineModel, test: DataFrame, label: str = "close") -> DataFrame:
    """M9: RMSE on the test rows, R^2 of the training summary and of the test rows."""
    pred = model.transform(test)
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    spark = test.sparkSession
    return spark.createDataFrame(
        [(float(ev.setMetricName("rmse").evaluate(pred)), float(model.stages[-1].summary.r2),
          float(ev.setMetricName("r2").evaluate(pred)))],
        "rmse_test double, r2_train double, r2_test double")


def sequence_regression(train: DataFrame, valid: DataFrame | None = None, window: str = "window",
                        label: str = "target", max_iter: int = 100, epsilon: float = 1.35,
                        penalties: Sequence[float] = (1e-4, 1e-2, 1.0)) -> PipelineModel:
    """Huber-loss linear regression on the flattened sequence window.

    With ``valid`` rows, the penalty is the one whose model has the least error
    there (what early stopping does for a network that is trained step by step:
    less fitting where more does not generalise); else the first one."""
    vec = train.withColumn("features", array_to_vector(window))
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    best, least = None, None
    for penalty in penalties if valid is not None else penalties[:1]:
        lr = LinearRegression(featuresCol="features", labelCol=label, loss="huber", epsilon=epsilon,
                              maxIter=max_iter, regParam=float(penalty))
        model = Pipeline(stages=[lr]).fit(vec)
        error = ev.evaluate(sequence_predict(model, valid, window)) if valid is not None else 0.0
        if least is None or error < least:
            best, least = model, error
    return best


def sequence_boosting(train: DataFrame, valid: DataFrame, window: str = "window", label: str = "target",
                      max_iter: int = 20, depth: int = 3, rate: float = 0.3, tolerance: float = 0.01,
                      seed: int = 7) -> PipelineModel:
    """M10 with early stopping: trees are added one by one to the flattened
    windows, and training stops at the first that betters the error on ``valid``
    by less than ``tolerance`` (relative)."""
    both = train.withColumn("_valid", F.lit(False)).unionByName(valid.withColumn("_valid", F.lit(True)))
    gbt = GBTRegressor(featuresCol="features", labelCol=label, validationIndicatorCol="_valid", maxIter=max_iter,
                       maxDepth=depth, stepSize=rate, validationTol=tolerance, maxBins=16, seed=seed,
                       featureSubsetStrategy="onethird")
    return Pipeline(stages=[gbt]).fit(both.withColumn("features", array_to_vector(window)))


def sequence_predict(model: PipelineModel, df: DataFrame, window: str = "window") -> DataFrame:
    return model.transform(df.withColumn("features", array_to_vector(window))).drop("features")


def save_model(model: PipelineModel, path: str, features: Sequence[str], spark) -> None:
    """Model + metadata (features, training time) side by side."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(list(features), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))],
                          "features array<string>, training_ts timestamp_ntz") \
        .write.mode("overwrite").parquet(f"{path}/meta")


def load_model(path: str, spark):
    """(PipelineModel, features list, metadata DataFrame)."""
    meta = spark.read.parquet(f"{path}/meta")
    features = meta.first()["features"]
    return PipelineModel.load(f"{path}/model"), list(features), meta

