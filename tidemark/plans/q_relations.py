"""Registered correlation queries."""

from __future__ import annotations

from tidemark.operators import correlation as co
from tidemark.operators.indicators import FEATURE_COLUMNS, technical_features
from tidemark.plans import fixtures as fx
from tidemark.plans import sqlparts as q
from tidemark.plans.catalog import finish, register

OHLCV = ["open", "high", "low", "close", "volume"]
FEATS = OHLCV + FEATURE_COLUMNS


def corr_long_sql(src: str, cols: list[str]) -> str:
    """CTEs s (numbered rows), lng (long values), cl (pairwise correlations)."""
    parts = " UNION ALL ".join(
        f"SELECT rid, series, '{c}' AS name, {i} AS idx, CAST({c} AS DOUBLE) AS v FROM s"
        for i, c in enumerate(cols))
    return (f"s AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM ({src})), "
            f"lng AS MATERIALIZED ({parts}), "
            "cl AS (SELECT a.series, a.name AS column_1, b.name AS column_2, a.idx AS i, "
            "b.idx AS j, count(*) AS n, CASE WHEN min(a.v) = max(a.v) OR min(b.v) = max(b.v) "
            "THEN NULL ELSE corr(a.v, b.v) END AS correlation FROM lng a JOIN lng b "
            "ON a.rid = b.rid AND a.series = b.series WHERE a.v IS NOT NULL AND b.v IS NOT NULL "
            "GROUP BY ALL)")


def _features_src() -> str:
    from tidemark.plans.q_indicators import _features_sql
    return _features_sql(q.BARS_HOURLY)


def _with_features(body_ctes: str, select: str) -> str:
    """Features SQL with its final SELECT turned into CTE f, then more CTEs."""
    head, _, rest = _features_src().partition("\nSELECT series, bar_ts")
    return f"{head},\nf AS (SELECT series, bar_ts{rest}),\n{body_ctes}\n{select}"


def _bars_long(spark, sf):
    return co.corr_long(fx.bars_hourly(spark, sf), ["series"], OHLCV)


def _feat_long(spark, sf):
    feats = technical_features(fx.bars_hourly(spark, sf))
    return fx.shared(co.corr_long(feats, ["series"], FEATS))


# C1
@register("corr_long", f"WITH {corr_long_sql(q.BARS_HOURLY, OHLCV)} SELECT * FROM cl",
          ["correlation"])
def corr_long(spark, sf):
    return finish(_bars_long(spark, sf))


# C2
@register("corr_pivot", f"WITH {corr_long_sql(q.BARS_HOURLY, OHLCV)} SELECT series, column_1, "
          + ", ".join(f"max(correlation) FILTER (WHERE column_2 = '{c}') AS {c}" for c in OHLCV)
          + " FROM cl GROUP BY series, column_1", OHLCV)
def corr_pivot(spark, sf):
    return finish(co.corr_pivot(_bars_long(spark, sf), ["series"], OHLCV))


# C3
@register("corr_features", _with_features(corr_long_sql("SELECT * FROM f", FEATS),
                                          "SELECT * FROM cl"), ["correlation"])
def corr_features(spark, sf):
    return finish(_feat_long(spark, sf))


# C4
@register("high_corr_pairs", _with_features(
    corr_long_sql("SELECT * FROM f", FEATS),
    "SELECT series, column_1 AS feature_1, column_2 AS feature_2, correlation FROM cl "
    f"WHERE i > j AND abs(correlation) > {co.HIGH_CORR}"), ["correlation"])
def high_corr_pairs(spark, sf):
    return finish(co.high_corr_pairs(_feat_long(spark, sf), ["series"]))


# C5
@register("target_corr", _with_features(
    corr_long_sql("SELECT * FROM f", FEATS),
    "SELECT series, column_1 AS feature, correlation, CAST(row_number() OVER (PARTITION BY series "
    "ORDER BY abs(correlation) DESC NULLS LAST, column_1) AS INTEGER) AS rank FROM cl "
    "WHERE column_2 = 'returns' QUALIFY rank <= 10"), ["correlation"])
def target_corr(spark, sf):
    return finish(co.target_corr(_feat_long(spark, sf), ["series"]))


def _groups_sql() -> str:
    rows = ", ".join(f"('{g}', '{f}')" for g, fs in co.FEATURE_GROUPS.items() for f in fs)
    return f"gm AS (SELECT * FROM (VALUES {rows}) AS t(feature_group, feature))"


_GROUP_SEL = ("SELECT cl.*, g1.feature_group FROM cl JOIN gm g1 ON g1.feature = cl.column_1 "
              "JOIN gm g2 ON g2.feature = cl.column_2 AND g2.feature_group = g1.feature_group")


# C6
@register("group_corr", _with_features(
    corr_long_sql("SELECT * FROM f", FEATS) + ", " + _groups_sql(), _GROUP_SEL), ["correlation"])
def group_corr(spark, sf):
    return finish(co.group_corr(_feat_long(spark, sf), co.group_map(spark)))


# C7
@register("group_corr_mean", _with_features(
    corr_long_sql("SELECT * FROM f", FEATS) + ", " + _groups_sql() + f", gc AS ({_GROUP_SEL})",
    "SELECT series, feature_group, avg(m) AS mean_correlation FROM (SELECT series, feature_group, "
    "column_2, avg(correlation) AS m FROM gc GROUP BY ALL) GROUP BY ALL"), ["mean_correlation"])
def group_corr_mean(spark, sf):
    sub = co.group_corr(_feat_long(spark, sf), co.group_map(spark))
    return finish(co.group_corr_mean(sub, ["series"]))
