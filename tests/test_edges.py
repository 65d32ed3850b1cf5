"""Edge fixtures: flat prices, zero moves, one-sided moves, empty denominators."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import correlation as co
from tidemark.operators import evaluate as ev
from tidemark.operators import indicators as ind


def _frame(spark, actual, predicted, series="s"):
    ts = pd.date_range("2024-01-01", periods=len(actual), freq="h")
    pdf = pd.DataFrame({"series": series, "bar_ts": ts, "actual": actual,
                        "predicted": predicted})
    return spark.createDataFrame(pdf).withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))


def _bars(spark, closes):
    ts = pd.date_range("2024-01-01", periods=len(closes), freq="h")
    pdf = pd.DataFrame({"series": "s", "bar_ts": ts, "open": closes, "high": closes,
                        "low": closes, "close": closes, "volume": 1})
    return spark.createDataFrame(pdf).withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))


def test_flat_prices(spark):
    feats = ind.technical_features(_bars(spark, np.full(40, 7.0)), fill_zero=False)
    out = feats.toPandas()
    full = out.dropna(subset=["bb_middle"])
    assert (full["bb_upper"] == full["bb_lower"]).all()          # zero width
    assert out["k_line"].isna().all()                             # 0/0 range: undefined
    assert (out["rsi"].dropna() == 0).all()                       # 0/0 gains and losses
    long = co.corr_long(feats, ["series"], ["close", "volume", "returns"]).toPandas()
    assert long[(long.column_1 == "close")]["correlation"].isna().all()


def test_directions_all_up_and_zero_moves(spark):
    up = _frame(spark, [1.0, 2.0, 3.0, 4.0, 5.0], [1.0, 1.5, 2.0, 2.5, 3.0])
    dirs = ev.direction_frame(up)
    m = ev.directional_metrics(dirs).first()
    assert m["overall_accuracy"] == 100.0 and m["up_accuracy"] == 100.0
    assert m["down_accuracy"] == 0.0                              # no down moves -> 0
    prf = ev.precision_recall_f1(dirs).first()
    assert prf["precision"] == 100.0 and prf["recall"] == 100.0 and prf["f1"] == 100.0
    flat = _frame(spark, [2.0, 2.0, 2.0, 2.0], [2.0, 3.0, 3.0, 3.0])
    fd = ev.direction_frame(flat)
    fm = ev.directional_metrics(fd).first()
    assert fm["up_accuracy"] == 0.0 and fm["down_accuracy"] == 0.0
    fp = ev.precision_recall_f1(fd).first()
    assert (fp["precision"], fp["recall"], fp["f1"]) == (0.0, 0.0, 0.0)
    assert ev.confusion_counts(fd).count() == 0                   # zero moves excluded
    acc = ev.directional_accuracy_diff(flat).first()
    assert acc["comparisons"] == 3
    assert abs(acc["directional_accuracy"] - 200.0 / 3) < 1e-9   # 0 == 0 matches twice


def test_regression_metrics_perfect_and_constant(spark):
    perfect = ev.regression_metrics(_frame(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0])).first()
    assert perfect["rmse"] == 0.0 and perfect["r2"] == 1.0 and perfect["mape"] == 0.0
    const = ev.regression_metrics(_frame(spark, [2.0, 2.0, 2.0], [1.0, 2.0, 3.0])).first()
    assert const["r2"] is None                                    # SST = 0: undefined
