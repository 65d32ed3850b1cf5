"""Workflow-level entry points: each analysis step of the reference
workflow as one call returning (dicts of) lazy DataFrames.

Every function composes the distributed operators; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators import correlation as co
from tidemark.operators import evaluate as ev
from tidemark.operators import forecast as fc
from tidemark.operators import indicators as ind
from tidemark.operators import mlprep as mp
from tidemark.operators import quality as ql
from tidemark.operators.ordered import HOURLY, Layout

PRICE_COLUMNS = ["open", "high", "low", "close", "volume"]


def profile(df: DataFrame, keys: Sequence[str] = ("series",),
            columns: Sequence[str] = PRICE_COLUMNS) -> dict[str, DataFrame]:
    """Overview, missing values, duplicates, statistics, outliers, box data."""
    keys = list(keys)
    return {
        "overview": ql.overview(df),
        "missing": ql.missing_report(df),
        "duplicates": ql.duplicate_count(df),
        "describe": ql.describe(df, keys, columns),
        "summary": ql.summary_stats(df, keys, columns),
        "outliers": ql.iqr_outliers(df, keys, columns),
        "box": ql.box_stats(df, keys, columns),
    }


def clean(df: DataFrame, columns: Sequence[str] = PRICE_COLUMNS, method: str = "ffill",
          layout: Layout = HOURLY) -> DataFrame:
    """Fill missing values by forward fill or linear interpolation."""
    if method == "ffill":
        return ql.forward_fill(df, columns, layout)
    if method == "linear":
        return ql.interpolate_linear(df, columns, layout)
    raise ValueError(method)


def engineer_features(bars: DataFrame, layout: Layout = HOURLY,
                      fill_zero: bool = True) -> DataFrame:
    """The 22-column daily feature table."""
    return ind.technical_features(bars, layout, fill_zero)


def calculate_technical_indicators(bars: DataFrame, layout: Layout = HOURLY,
                                   weighted: bool = False) -> DataFrame:
    """The nine indicators of the intraday scoring path."""
    return ind.realtime_features(bars, layout, weighted)


def analyze_correlations(features: DataFrame, keys: Sequence[str] = ("series",),
                         columns: Sequence[str] | None = None,
                         target: str = "returns") -> dict[str, DataFrame]:
    """Matrix (long), strong pairs, target ranking, feature-group blocks."""
    keys = list(keys)
    columns = list(columns or PRICE_COLUMNS + ind.FEATURE_COLUMNS)
    long = co.corr_long(features, keys, columns)
    groups = co.group_corr(long, co.group_map(features.sparkSession))
    return {
        "correlation_matrix": long,
        "high_correlations": co.high_corr_pairs(long, keys),
        "returns_correlations": co.target_corr(long, keys, target),
        "group_correlations": groups,
        "group_means": co.group_corr_mean(groups, keys),
    }


def directional_analysis(frame: DataFrame, layout: Layout = HOURLY) -> dict[str, DataFrame]:
    """Direction metrics of (series, bar_ts, actual, predicted)."""
    dirs = ev.direction_frame(frame, layout)
    return {
        "metrics": ev.directional_metrics(dirs),
        "confusion": ev.confusion_counts(dirs),
        "precision_recall_f1": ev.precision_recall_f1(dirs),
        "rolling_accuracy": ev.rolling_accuracy(dirs, layout),
        "cumulative_returns": ev.cumulative_return(dirs, layout),
    }


def evaluate_forecast(frame: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    """Error metrics, directional accuracy and error summary per series."""
    return ev.evaluation_report(frame, layout)


def forecast_sarima(bars: DataFrame, order: fc.Order = fc.ORDER_A, layout: Layout = HOURLY,
                    train: float = 0.8, log: bool = False, column: str = "close") -> DataFrame:
    """Chronological split, two-stage fit, test-period forecast with 95 % band."""
    split = mp.chrono_split(bars, layout, train, keep_pos=True)
    return fc.sarima_forecast(split, column, order, layout=layout, log=log)
