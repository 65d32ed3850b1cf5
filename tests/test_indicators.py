"""Indicators against pandas (second oracle) and edge fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tidemark.operators import indicators as ind
from tidemark.operators.ordered import Layout
from tidemark.plans import fixtures as fx

SMALL = Layout(block_seconds=3600 * 64, chunk_rows=1280)  # several chunks per series


def _bars(spark, closes, series="s", start="2024-01-01"):
    ts = pd.date_range(start, periods=len(closes), freq="h")
    pdf = pd.DataFrame({"series": series, "bar_ts": ts, "open": closes, "high": closes,
                        "low": closes, "close": closes, "volume": 1})
    pdf["high"] = pdf["close"] + 1.0
    pdf["low"] = pdf["close"] - 1.0
    return spark.createDataFrame(pdf).withColumn("bar_ts", __import__(
        "pyspark.sql.functions", fromlist=["col"]).col("bar_ts").cast("timestamp_ntz"))


def _sorted(df):
    return df.toPandas().sort_values(["series", "bar_ts"]).reset_index(drop=True)


def test_ema_blocked_scan_matches_pandas_on_long_walk(spark):
    rng = np.random.default_rng(7)
    closes = 100 + np.cumsum(rng.normal(size=20000))
    out = _sorted(ind.ema(_bars(spark, closes), SMALL, spans=(5, 9, 12, 20, 26)))
    for span in (5, 9, 12, 20, 26):
        want = pd.Series(closes).ewm(span=span, adjust=False).mean().to_numpy()
        rel = np.abs(out[f"ema_{span}"].to_numpy() - want) / np.abs(want)
        assert rel.max() < 1e-12, span


def test_macd_signal_signed_input(spark):
    rng = np.random.default_rng(3)
    closes = 50 + np.cumsum(rng.normal(size=5000))
    out = _sorted(ind.macd(_bars(spark, closes), SMALL))
    s = pd.Series(closes)
    macd = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
    sig = macd.ewm(span=9, adjust=False).mean()
    assert np.allclose(out["macd"], macd, atol=1e-9)
    assert np.allclose(out["macd_signal"], sig, atol=1e-9)


def test_features_invariant_to_chunk_size(spark):
    from tidemark.plans import fixtures as fx
    bars = fx.bars_minute(spark, SF_MID)
    a = _sorted(ind.technical_features(bars, Layout(block_seconds=60 * 512, chunk_rows=1280)))
    b = _sorted(ind.technical_features(bars, Layout(block_seconds=60 * 4096)))
    for c in ind.FEATURE_COLUMNS:
        assert np.allclose(a[c], b[c], rtol=1e-10, atol=1e-10), c


def test_rsi_flat_and_rising(spark):
    flat = _sorted(ind.rsi(_bars(spark, np.full(40, 10.0))))
    assert flat["rsi"].isna().sum() == 13 and (flat["rsi"].dropna() == 0).all()
    rising = np.arange(40, dtype=float) + 1
    batch = _sorted(ind.rsi(_bars(spark, rising)))
    live = _sorted(ind.rsi_partial(_bars(spark, rising)))
    assert (batch["rsi"].dropna() == 100).all()
    assert (live["rsi"] == 0).all()


@pytest.mark.parametrize("n", [13, 14, 19, 20, 21])
def test_first_defined_rows(spark, n):
    rng = np.random.default_rng(n)
    closes = 100 + np.cumsum(rng.normal(size=n))
    out = _sorted(ind.technical_features(_bars(spark, closes), fill_zero=False))
    first = {c: (out[c].first_valid_index() if out[c].notna().any() else None)
             for c in ("rsi", "atr", "sma_20", "daily_volatility")}
    assert first["rsi"] == (13 if n > 13 else None)
    assert first["atr"] == (13 if n > 13 else None)
    assert first["sma_20"] == (19 if n > 19 else None)
    assert first["daily_volatility"] == (20 if n > 20 else None)


def test_feature_properties(spark):
    from tidemark.plans import fixtures as fx
    out = _sorted(ind.technical_features(fx.bars_hourly(spark, SF_MID), fill_zero=False))
    assert out["rsi"].dropna().between(0, 100).all()
    k = out["k_line"].dropna()
    assert k.between(0, 100).all()
    bb = out.dropna(subset=["bb_middle"])
    assert (bb["bb_lower"] <= bb["bb_middle"] + 1e-9).all()
    assert (bb["bb_middle"] <= bb["bb_upper"] + 1e-9).all()


def test_window_ema_matches_python_recursion(spark):
    closes = np.array([3.0, 5.0, 4.0, 8.0, 7.0, 9.0, 6.0, 10.0])
    out = _sorted(ind.ema_window(_bars(spark, closes)))
    a = 2 / 6
    for i in range(len(closes)):
        win = closes[max(0, i - 4): i + 1]
        e = win[0]
        for x in win[1:]:
            e = x * a + e * (1 - a)
        assert out["ema_5"][i] == pytest.approx(e, rel=1e-12)


@pytest.mark.parametrize("spans", [(5, 20), (1, 2, 3), (2, 400), (9, 26, 100)])
def test_ema_with_even_blocks(spark, spans):
    """Without nulls, blocks of positions give what decaying blocks and pandas give,
    also with short chunks and spans whose blocks differ."""
    rng = np.random.default_rng(len(spans))
    base = pd.Timestamp("2020-01-01")
    rows = [(s, base + pd.Timedelta(hours=i), float(v)) for s, n in (("a", 5000), ("b", 3), ("c", 700))
            for i, v in enumerate(100 + np.cumsum(rng.normal(size=n)))]
    pdf = pd.DataFrame(rows, columns=["series", "bar_ts", "close"])
    bars = spark.createDataFrame(pdf).withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))
    layout = Layout(block_seconds=512 * 3600, chunk_rows=1500)
    for gaps in (False, None):
        got = ind.ema(bars, layout, spans, gaps=gaps).toPandas().sort_values(["series", "bar_ts"]).reset_index(drop=True)
        for n in spans:
            want = pdf.groupby("series")["close"].transform(lambda x, n=n: x.ewm(span=n, adjust=False).mean())
            assert np.abs(got[f"ema_{n}"] - want).max() < 1e-9


def test_one_order_of_rows_for_all_averages(spark):
    bars = fx.bars_hourly(spark, SF_MID)
    plan = ind.technical_features(bars, gaps=False)._jdf.queryExecution().executedPlan().toString()
    sorts = [x for x in plan.split("\n") if "Sort [" in x and "_chunk" in x]
    assert len(sorts) == 2  # row frames, averages
