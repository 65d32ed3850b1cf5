"""Workflow-level API smoke test on the smallest scale factor."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark import api
from tidemark.plans import fixtures as fx


def test_workflow(spark):
    bars = fx.bars_hourly(spark, SF_SMALL)
    prof = api.profile(bars)
    assert prof["overview"].count() == 7
    feats = api.engineer_features(bars)
    assert feats.count() == bars.count()
    corr = api.analyze_correlations(feats)
    assert corr["correlation_matrix"].count() > 0
    rt = api.calculate_technical_indicators(bars)
    assert "rsi" in rt.columns
    filled = api.clean(fx.with_nulls(bars), ["close"], "linear")
    assert filled.count() == bars.count()
    frame = (bars.select("series", "bar_ts", F.col("close").alias("actual"))
             .join(bars.select("series", "bar_ts", (F.col("open")).alias("predicted")),
                   ["series", "bar_ts"]))
    assert api.evaluate_forecast(frame).count() == 5
    assert api.directional_analysis(frame)["metrics"].count() == 5
    out = api.forecast_sarima(bars)
    assert set(out.columns) >= {"predicted", "lower", "upper"}
