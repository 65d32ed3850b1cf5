"""Registered profiling / cleaning / projection queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidemark.functions import sketches as sk
from tidemark.operators import projection as pj
from tidemark.operators import quality as ql
from tidemark.operators.indicators import sma as ind_sma
from tidemark.operators.indicators import technical_features
from tidemark.operators.ml import LR_FEATURES
from tidemark.operators.mlprep import chrono_split
from tidemark.operators.ordered import HOURLY
from tidemark.plans import fixtures as fx
from tidemark.plans import sqlparts as q
from tidemark.plans.catalog import finish, register

B = ["series", "bar_ts", "open", "high", "low", "close", "volume"]
BD = ["open", "high", "low", "close"]
_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]
PROFILE = ["open", "high", "low", "close", "volume"]
W = q.w()

NULL_BARS = q.NULL_BARS


def _nulls(spark, sf):
    return fx.with_nulls(fx.bars_hourly(spark, sf))


def _long_sql(src: str, keys: list[str], cols: list[str]) -> str:
    k = ", ".join(keys)
    parts = [f"SELECT {k}{', ' if k else ''}'{c}' AS column_name, CAST({c} AS DOUBLE) AS value "
             f"FROM {src}" for c in cols]
    return " UNION ALL ".join(parts)


# Q1
_OV_VALUES = ", ".join(f"('{c}', '{t}', {i + 1})" for i, (c, t) in enumerate(
    [("series", "string"), ("bar_ts", "timestamp_ntz"), ("open", "double"), ("high", "double"),
     ("low", "double"), ("close", "double"), ("volume", "bigint")]))


@register("overview", f"SELECT c.column_name, c.data_type, c.ordinal, n.n_rows, 7 AS n_columns "
          f"FROM (VALUES {_OV_VALUES}) AS c(column_name, data_type, ordinal), "
          f"(SELECT count(*) AS n_rows FROM ({q.BARS_HOURLY})) AS n", [])
def overview(spark, sf):
    return finish(ql.overview(fx.bars_hourly(spark, sf)))


# Q2
@register("missing_report", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, "
    f"(count(*) - count({c})) * 100.0 / count(*) AS pct_missing FROM ({NULL_BARS})" for c in B),
    ["pct_missing"])
def missing_report(spark, sf):
    return finish(ql.missing_report(_nulls(spark, sf)))


# Q3
@register("duplicate_count", "SELECT count(*) AS n_rows, count(DISTINCT (user_id, event_type)) "
          "AS n_distinct, count(*) - count(DISTINCT (user_id, event_type)) AS duplicates "
          "FROM events", [])
def duplicate_count(spark, sf):
    ev = fx.table(spark, sf, "events")
    return finish(ql.duplicate_count(ev, ["user_id", "event_type"]))


# Q4
@register("duplicate_rows", "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY "
          "user_id, event_type ORDER BY event_id) > 1", ["value"])
def duplicate_rows(spark, sf):
    ev = fx.table(spark, sf, "events")
    return finish(ql.duplicate_rows(ev, ["user_id", "event_type"], "event_id"))


# Q5
_STATS = ["count", "mean", "std", "min", "max", "p25", "p50", "p75"]


@register("describe", f"SELECT series, column_name, count(value) AS count, avg(value) AS mean, "
          f"stddev_samp(value) AS std, min(value) AS min, max(value) AS max, "
          f"quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, "
          f"quantile_cont(value, 0.75) AS p75 FROM ({_long_sql(f'({q.BARS_HOURLY})', ['series'], PROFILE)}) "
          f"GROUP BY series, column_name", _STATS[1:])
def describe(spark, sf):
    return finish(ql.describe(fx.bars_hourly(spark, sf), ["series"], PROFILE))


# Q6
_SUMMARY = [f"{c}_{s}" for c in PROFILE for s in ("mean", "stddev", "min", "max")]


@register("summary_stats", "SELECT series, " + ", ".join(
    f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_stddev, min({c}) AS {c}_min, "
    f"max({c}) AS {c}_max" for c in PROFILE) + f" FROM ({q.BARS_HOURLY}) GROUP BY series",
    [c for c in _SUMMARY if c not in ("volume_min", "volume_max")])
def summary_stats(spark, sf):
    return finish(ql.summary_stats(fx.bars_hourly(spark, sf), ["series"], PROFILE))


# Q7
_BOUNDS = (f"qs AS (SELECT series, column_name, quantile_cont(value, 0.25) AS q1, "
           f"quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY ALL), "
           f"bd AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_bound, "
           f"q3 + 1.5 * (q3 - q1) AS upper_bound FROM qs)")
_LNG = f"lng AS ({_long_sql(f'({q.BARS_HOURLY})', ['series'], PROFILE)})"


@register("iqr_outliers_exact", f"WITH {_LNG}, {_BOUNDS} SELECT bd.*, count(*) AS n_rows, "
          "count(*) FILTER (WHERE value < lower_bound OR value > upper_bound) AS outliers, "
          "count(*) FILTER (WHERE value < lower_bound OR value > upper_bound) * 100.0 / count(*) "
          "AS pct_outliers FROM bd JOIN lng USING (series, column_name) "
          "GROUP BY ALL", ["q1", "q3", "lower_bound", "upper_bound", "pct_outliers"])
def iqr_outliers_exact(spark, sf):
    return finish(ql.iqr_outliers(fx.bars_hourly(spark, sf), ["series"], PROFILE))


# Q8 (sketch quantiles: rows-only check)
@register("iqr_outliers_approx")
def iqr_outliers_approx(spark, sf):
    return finish(ql.iqr_outliers(fx.bars_hourly(spark, sf), ["series"], PROFILE, approx=True))


# Q8: quantiles of a sketch over all rows, of merged daily sketches and of Spark's own, by their exact ranks
@register("approx_quantile_ranks", "SELECT event_type AS series, 'value' AS column_name, p, count(value) AS n, "
          "TRUE AS one_pass, TRUE AS merged_days, TRUE AS percentile_approx FROM events, (VALUES " +
          ", ".join(f"({p}::DOUBLE)" for p in _PROBS) + ") t(p) GROUP BY event_type, p")
def approx_quantile_ranks(spark, sf):
    ticks = fx.shared(fx.table(spark, sf, "events").select(F.col("event_type").alias("series"), "ts", "value"))
    keys, by = ["series"], ["series", "column_name", "n", "p"]
    found = {"one_pass": sk.quantiles(sk.sketch(ticks, keys, ["value"]), _PROBS),
             "merged_days": sk.quantiles(sk.merge(sk.sketch(ticks, keys, ["value"], day="ts"), keys), _PROBS),
             "percentile_approx": ticks.groupBy(*keys).agg(F.percentile_approx("value", _PROBS, 10_000).alias("q")).select(
                 *keys, F.lit("value").alias("column_name"), F.explode(F.arrays_zip(
                     F.array(*[F.lit(p) for p in _PROBS]).alias("p"), "q")).alias("z")).select(*keys, "column_name", "z.*")}
    out = None
    for name, q_ in found.items():
        bound = 1 / 10_000 if name == "percentile_approx" else sk.rank_error()
        one = sk.outside_ranks(ticks, keys, ["value"], q_.drop("n")).select(
            *by, (F.col("rank_error") <= bound).alias(name))
        out = one if out is None else out.join(one, by)
    return out


# Q6 from merged daily states, without reading a row again
@register("sketch_summary", "SELECT event_type AS series, 'value' AS column_name, count(value) AS n, avg(value) AS mean, "
          "stddev_samp(value) AS stddev, min(value) AS low, max(value) AS high FROM events GROUP BY event_type",
          ["mean", "stddev", "low", "high"])
def sketch_summary(spark, sf):
    ticks = fx.table(spark, sf, "events").select(F.col("event_type").alias("series"), "ts", "value")
    return finish(sk.summary(sk.merge(sk.sketch(ticks, ["series"], ["value"], day="ts"), ["series"])).drop("sketch"))


# Q9
@register("outlier_rows", f"WITH bars AS ({q.BARS_HOURLY}), qs AS (SELECT series, "
          "quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.75) AS q3 FROM bars "
          "GROUP BY series) SELECT bars.* FROM bars JOIN qs USING (series) "
          "WHERE close < q1 - 1.5 * (q3 - q1) OR close > q3 + 1.5 * (q3 - q1)", BD)
def outlier_rows(spark, sf):
    return finish(ql.outlier_rows(fx.bars_hourly(spark, sf), ["series"], "close"))


# Q10
@register("zscore_clean", f"WITH bars AS ({q.BARS_HOURLY}), st AS (SELECT series, avg(close) AS mu, "
          "stddev_pop(close) AS sd, min(close) = max(close) AS flat FROM bars GROUP BY series) "
          "SELECT bars.*, CASE WHEN NOT flat AND abs((close - mu) / NULLIF(sd, 0)) > 3 THEN mu "
          "ELSE close END AS close_clean FROM bars JOIN st USING (series)", BD + ["close_clean"])
def zscore_clean(spark, sf):
    return finish(ql.zscore_clean(fx.bars_hourly(spark, sf), ["series"], "close",
                                  out="close_clean"))


# Q10, before a fit: only the train part is cleaned
@register("zscore_clean_train", f"WITH bars AS ({q.BARS_HOURLY}), p AS (SELECT *, row_number() {W} - 1 < "
          "floor(count(*) OVER (PARTITION BY series) * 0.8) AS fit FROM bars), st AS (SELECT series, avg(close) AS mu, "
          "stddev_pop(close) AS sd, min(close) = max(close) AS flat FROM p WHERE fit GROUP BY series) "
          f"SELECT {', '.join(B)}, CASE WHEN fit THEN 'train' ELSE 'test' END AS split, CASE WHEN fit AND NOT flat "
          "AND abs((close - mu) / NULLIF(sd, 0)) > 3 THEN mu ELSE close END AS close_clean "
          "FROM p JOIN st USING (series)", BD + ["close_clean"])
def zscore_clean_train(spark, sf):
    split = chrono_split(fx.bars_hourly(spark, sf))
    return finish(ql.zscore_clean(split, ["series"], "close", out="close_clean", fit=F.col("split") == "train"))


# Q11
@register("forward_fill", f"SELECT series, bar_ts, open, high, low, coalesce(close, "
          f"last_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY bar_ts ROWS BETWEEN "
          f"UNBOUNDED PRECEDING AND CURRENT ROW)) AS close, volume FROM ({NULL_BARS})", BD)
def forward_fill(spark, sf):
    return finish(ql.forward_fill(_nulls(spark, sf), ["close"], HOURLY))


# Q12
_INTERP = (f"WITH nb AS (SELECT *, row_number() {W} - 1 AS pos FROM ({NULL_BARS})), "
           "nn AS (SELECT *, "
           "last_value(CASE WHEN close IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY "
           "series ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi, "
           "last_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN "
           "UNBOUNDED PRECEDING AND CURRENT ROW) AS pv, "
           "first_value(CASE WHEN close IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY "
           "series ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni, "
           "first_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN "
           "CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM nb) "
           "SELECT series, bar_ts, open, high, low, coalesce(close, CASE WHEN pi IS NULL THEN NULL "
           "WHEN ni IS NULL THEN pv ELSE (nv - pv) / CAST(ni - pi AS DOUBLE) * "
           "CAST(pos - pi AS DOUBLE) + pv END) AS close, volume FROM nn")


@register("interpolate_linear", _INTERP, BD)
def interpolate_linear(spark, sf):
    return finish(ql.interpolate_linear(_nulls(spark, sf), ["close"], HOURLY))


# Q13
_BINS = 50


@register("histogram", f"WITH bars AS ({q.BARS_HOURLY}), st AS (SELECT series, min(close) AS lo, "
          "max(close) AS hi FROM bars GROUP BY series), "
          "c AS (SELECT series, CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((close - lo) / "
          f"(hi - lo) * {float(_BINS)}) + 1, {_BINS}) END AS INTEGER) AS bin, count(*) AS cnt "
          "FROM bars JOIN st USING (series) WHERE close IS NOT NULL GROUP BY ALL), "
          f"g AS (SELECT series, lo, hi, CAST(unnest(generate_series(1, {_BINS})) AS INTEGER) AS bin "
          "FROM st) SELECT g.series, g.bin, lo + (g.bin - 1) * ((hi - lo) / "
          f"{float(_BINS)}) AS bin_lower, lo + g.bin * ((hi - lo) / {float(_BINS)}) AS bin_upper, "
          "coalesce(cnt, 0) AS count FROM g LEFT JOIN c USING (series, bin)",
          ["bin_lower", "bin_upper"])
def histogram(spark, sf):
    return finish(ql.histogram(fx.bars_hourly(spark, sf), ["series"], "close", _BINS))


# Q14
@register("kde_grid", f"WITH bars AS ({q.BARS_HOURLY}), st0 AS (SELECT series, count(close) AS n, "
          "stddev_samp(close) AS sd, min(close) AS lo, max(close) AS hi FROM bars GROUP BY series), "
          "st1 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st0), "
          f"st AS (SELECT *, lo - {ql.KDE_CUT} * h AS g0, (hi - lo + 2 * {ql.KDE_CUT} * h) / "
          f"{float(ql.KDE_GRID - 1)} AS step FROM st1 WHERE h > 0), "
          f"gr AS (SELECT *, CAST(unnest(generate_series(0, {ql.KDE_GRID - 1})) AS INTEGER) AS g "
          "FROM st) SELECT gr.series, gr.g, g0 + g * step AS x, "
          "sum(exp(-0.5 * ((g0 + g * step - close) / h) * ((g0 + g * step - close) / h))) / "
          f"(n * h * {math.sqrt(2 * math.pi)!r}) AS density FROM gr JOIN bars USING (series) "
          "WHERE close IS NOT NULL GROUP BY gr.series, gr.g, g0, step, n, h", ["x", "density"])
def kde_grid(spark, sf):
    return finish(ql.kde_grid(fx.bars_hourly(spark, sf), ["series"], "close"))


# Q14 by linear binning: flagged where it is within the bound of the exact density
@register("kde_binned", f"WITH bars AS ({q.BARS_HOURLY}), st0 AS (SELECT series, count(close) AS n, "
          "stddev_samp(close) AS sd, min(close) AS lo, max(close) AS hi FROM bars GROUP BY series), "
          "st1 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st0) "
          f"SELECT series, g::INTEGER AS g, lo - {ql.KDE_CUT} * h + g * ((hi - lo + 2 * {ql.KDE_CUT} * h) / "
          f"{float(ql.KDE_GRID - 1)}) AS x, TRUE AS within FROM st1, range(0, {ql.KDE_GRID}) t(g) WHERE h > 0", ["x"])
def kde_binned(spark, sf):
    bars = fx.bars_hourly(spark, sf)
    exact = ql.kde_grid(bars, ["series"], "close").select("series", "g", F.col("density").alias("exact"))
    both = ql.kde_binned(bars, ["series"], "close").join(exact, ["series", "g"])
    return finish(both.select("series", "g", "x", (F.abs(F.col("density") - F.col("exact")) <= F.col("bound")).alias("within")))


# Q15
_BOX = ["q1", "median", "q3", "min", "max", "lower_whisker", "upper_whisker"]


@register("box_stats", f"WITH {_LNG}, qs AS (SELECT series, column_name, "
          "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
          "quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY ALL) SELECT qs.*, min(value) AS min, "
          "max(value) AS max, min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS "
          "lower_whisker, max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS "
          "upper_whisker, count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR "
          "value > q3 + 1.5 * (q3 - q1)) AS outliers FROM qs JOIN lng USING (series, column_name) "
          "GROUP BY ALL", _BOX)
def box_stats(spark, sf):
    return finish(ql.box_stats(fx.bars_hourly(spark, sf), ["series"], PROFILE))


# ------------------------------------------------------------------ projections

# P1
@register("project_cast", "SELECT strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS ship_date, "
          "CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DOUBLE) AS price, "
          "l_returnflag AS flag FROM lineitem", ["price"])
def project_cast(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    out = pj.project_cast(li, {"l_shipdate": ("date", "ship_date"),
                               "l_quantity": ("bigint", "quantity"),
                               "l_extendedprice": ("double", "price"),
                               "l_returnflag": ("string", "flag")})
    # dates leave as ISO text: date objects compare differently across engines
    return finish(out.withColumn("ship_date", F.date_format("ship_date", "yyyy-MM-dd")))


# P2
@register("cast_dates", "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS order_day, "
          "CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_ts "
          "FROM orders", [])
def cast_dates(spark, sf):
    o = fx.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("order_day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts"))
    out = pj.cast_dates(o, {"order_day": "date", "order_ts": "timestamp_ntz"})
    return finish(out.withColumn("order_day", F.date_format("order_day", "yyyy-MM-dd")))


# P3
@register("cast_numeric", "SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, "
          "TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS l_quantity FROM lineitem",
          ["l_linenumber", "l_quantity"])
def cast_numeric(spark, sf):
    li = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("l_quantity"))
    return finish(pj.cast_numeric(li, ["l_linenumber", "l_quantity"]))


# P4
_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax"]


@register("numeric_columns", f"SELECT {', '.join(_LI_NUM)} FROM lineitem", _LI_NUM[4:])
def numeric_columns(spark, sf):
    return finish(pj.select_numeric(fx.table(spark, sf, "lineitem")))


# P5
@register("normalize_names", "SELECT series AS \"Series\", bar_ts AS \"Datetime\", open AS \"Open\", "
          f"high AS \"High\", low AS \"Low\", close AS \"Close\", volume AS \"Volume\" FROM ({q.BARS_HOURLY})",
          ["Open", "High", "Low", "Close"])
def normalize_names(spark, sf):
    b = fx.bars_hourly(spark, sf).withColumnRenamed("bar_ts", "date")
    return finish(pj.normalize_names(b, {"Date": "Datetime"}))


# P6
@register("drop_columns", "SELECT event_id, ts, event_type, value FROM events", ["value"])
def drop_columns(spark, sf):
    return finish(pj.drop_columns(fx.table(spark, sf, "events"), ["user_id", "props"]))


# P7
@register("drop_nulls", f"SELECT * FROM ({NULL_BARS}) WHERE close IS NOT NULL", BD)
def drop_nulls(spark, sf):
    return finish(pj.drop_nulls(_nulls(spark, sf)))


# P8
@register("fill_zero", f"SELECT series, bar_ts, open, high, low, coalesce(close, 0) AS close, "
          f"volume FROM ({NULL_BARS})", BD)
def fill_zero(spark, sf):
    from tidemark.operators.indicators import fill_zero_op
    return finish(fill_zero_op(_nulls(spark, sf)))


# P9
@register("set_index_sort", f"SELECT * FROM ({q.BARS_HOURLY}) ORDER BY bar_ts, series", BD)
def set_index_sort(spark, sf):
    return finish(pj.set_index_sort(fx.bars_hourly(spark, sf), ["bar_ts", "series"]))


# P10
@register("head_k", f"SELECT * FROM ({q.BARS_HOURLY}) ORDER BY volume DESC, series, bar_ts LIMIT 10",
          BD)
def head_k(spark, sf):
    return finish(pj.head_k(fx.bars_hourly(spark, sf), 10,
                            [F.col("volume").desc(), "series", "bar_ts"]))


@register("latest_row", f"SELECT * FROM ({q.BARS_HOURLY}) QUALIFY row_number() OVER "
          "(PARTITION BY series ORDER BY bar_ts DESC) = 1", BD)
def latest_row(spark, sf):
    return finish(pj.latest_per_series(fx.bars_hourly(spark, sf)))


# P11
@register("log_price", f"SELECT *, {q.ln('close')} AS log_price, exp({q.ln('close')}) AS price_back "
          f"FROM ({q.BARS_HOURLY})", BD + ["log_price", "price_back"])
def log_price(spark, sf):
    df = pj.log_price(fx.bars_hourly(spark, sf))
    return finish(df.withColumn("price_back", F.exp("log_price")))


# P12
_NZ = LR_FEATURES


def _nz_sql() -> str:
    """Column sums over the oracle's feature table (its final SELECT becomes a CTE)."""
    from tidemark.plans.q_indicators import _features_sql
    head, _, rest = _features_sql(q.BARS_HOURLY).partition("\nSELECT series, bar_ts")
    body = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(sum({c}) AS DOUBLE) AS total, sum({c}) <> 0 AS keep "
        f"FROM f" for c in _NZ)
    return f"{head},\nf AS (SELECT series, bar_ts{rest}) {body}"


@register("nonzero_features", _nz_sql(), ["total"])
def nonzero_features(spark, sf):
    feats = technical_features(fx.bars_hourly(spark, sf))
    return finish(pj.column_sums(feats, _NZ))


# Rows with a null series, time stamp or order key stay: each operator family over such a fixture
_NK = f"({q.NULL_KEY_BARS})"


def _null_keys(spark, sf):
    return fx.with_null_keys(fx.bars_hourly(spark, sf))


@register("sma_null_keys", f"SELECT *, CASE WHEN count(close) {q.w(5)} = 5 THEN avg(close) {q.w(5)} END AS sma_5 "
          f"FROM {_NK}", BD + ["sma_5"])
def sma_null_keys(spark, sf):
    return finish(ind_sma(_null_keys(spark, sf)).drop("sma_20"))


@register("chrono_split_null_keys", f"SELECT *, CASE WHEN row_number() {W} - 1 < floor(count(*) OVER (PARTITION BY "
          f"series) * 0.8) THEN 'train' ELSE 'test' END AS split FROM {_NK}", BD)
def chrono_split_null_keys(spark, sf):
    return finish(chrono_split(_null_keys(spark, sf)))


@register("describe_null_keys", "SELECT series, column_name, count(value) AS count, avg(value) AS mean, "
          "stddev_samp(value) AS std, min(value) AS min, max(value) AS max, quantile_cont(value, 0.25) AS p25, "
          "quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75 "
          f"FROM ({_long_sql(_NK, ['series'], PROFILE)}) GROUP BY series, column_name", _STATS[1:])
def describe_null_keys(spark, sf):
    return finish(ql.describe(_null_keys(spark, sf), ["series"], PROFILE))


@register("zscore_clean_null_keys", f"WITH st AS (SELECT series, avg(close) AS mu, stddev_pop(close) AS sd FROM {_NK} "
          f"GROUP BY series) SELECT b.*, CASE WHEN abs((close - mu) / NULLIF(sd, 0)) > 1.5 THEN mu ELSE close END "
          f"AS close_clean FROM {_NK} b JOIN st ON b.series IS NOT DISTINCT FROM st.series", BD + ["close_clean"])
def zscore_clean_null_keys(spark, sf):
    return finish(ql.zscore_clean(_null_keys(spark, sf), ["series"], "close", 1.5, out="close_clean"))


@register("forward_fill_null_keys", "SELECT series, bar_ts, open, high, low, coalesce(c, last_value(c IGNORE NULLS) OVER "
          "(PARTITION BY series ORDER BY bar_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS close, volume "
          f"FROM (SELECT *, CASE WHEN volume % 2 = 0 THEN close END AS c FROM {_NK})", BD)
def forward_fill_null_keys(spark, sf):
    bars = _null_keys(spark, sf)
    return finish(ql.forward_fill(bars.withColumn("close", F.when(F.col("volume") % 2 == 0, F.col("close"))),
                                  ["close"], HOURLY))


@register("duplicate_rows_null_order", "SELECT * FROM (SELECT event_type, user_id, nullif(event_id, event_id // 3 * 3) "
          "AS k FROM events) QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY k) > 1")
def duplicate_rows_null_order(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_type", "user_id", F.expr(
        "nullif(event_id, event_id div 3 * 3)").alias("k"))
    return ql.duplicate_rows(ev, ["event_type", "user_id"], "k")
