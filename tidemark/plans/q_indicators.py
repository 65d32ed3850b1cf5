"""Registered indicator queries (W1-W23) on the hourly event bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import indicators as ind
from tidemark.operators.ordered import DAILY, HOURLY
from tidemark.plans import fixtures as fx
from tidemark.plans import sqlparts as q
from tidemark.plans.catalog import finish, register
from tidemark.session import materialize
from tidemark.sources.bars import BAR_COLUMNS, bar_states, roll_up

B = ["series", "bar_ts", "open", "high", "low", "close", "volume"]
BD = ["open", "high", "low", "close"]
W = q.w()
PREV = f"lag(close) {W}"


def _sel(extra: str, src: str = "b", ctes: str = "", bars: str = q.BARS_HOURLY) -> str:
    return q.with_bars(f"SELECT {', '.join(B)}, {extra} FROM {src}", bars, ctes)


# W1
@register("returns", _sel(f"coalesce({q.div('close', PREV)} - 1, 0) AS returns"),
          BD + ["returns"])
def returns(spark, sf):
    return finish(ind.returns(fx.bars_hourly(spark, sf)))


# W2
@register("log_returns", _sel(f"coalesce({q.ln('close')} - {q.ln(PREV)}, 0) AS log_returns"),
          BD + ["log_returns"])
def log_returns(spark, sf):
    return finish(ind.log_returns(fx.bars_hourly(spark, sf)))


# W3
@register("price_range", _sel(f"high - low AS price_range, {q.div('high - low', 'close')} "
                              "AS price_range_pct"), BD + ["price_range", "price_range_pct"])
def price_range(spark, sf):
    return finish(ind.price_range(fx.bars_hourly(spark, sf)))


# W4
@register("price_range_open", _sel(f"high - low AS price_range, {q.div('high - low', 'open')} "
                                   "AS price_range_pct"), BD + ["price_range", "price_range_pct"])
def price_range_open(spark, sf):
    return finish(ind.price_range_open(fx.bars_hourly(spark, sf)))


# W5
@register("sma", _sel(f"{q.sma('close', 5)} AS sma_5, {q.sma('close', 20)} AS sma_20"),
          BD + ["sma_5", "sma_20"])
def sma(spark, sf):
    return finish(ind.sma(fx.bars_hourly(spark, sf)))


# W6
@register("sma_partial", _sel(f"avg(close) {q.w(5)} AS sma_5, avg(close) {q.w(20)} AS sma_20"),
          BD + ["sma_5", "sma_20"])
def sma_partial(spark, sf):
    return finish(ind.sma_partial_op(fx.bars_hourly(spark, sf)))


# W7
_EMA_SQL = q.with_bars(
    "SELECT bars.*, r.ema_5, r.ema_20 FROM bars JOIN b USING (series, bar_ts) "
    "JOIN r ON r.series = b.series AND r.pos = b.pos",
    q.BARS_HOURLY,
    q.ema_recursive("b", [("close", 5, "ema_5"), ("close", 20, "ema_20")], []),
).replace("WITH bars AS", "WITH RECURSIVE bars AS")


@register("ema", _EMA_SQL, BD + ["ema_5", "ema_20"])
def ema(spark, sf):
    return finish(ind.ema(fx.bars_hourly(spark, sf)))


def _list_ema(n: int) -> str:
    a = 2.0 / (n + 1.0)
    return (f"list_reduce(list(close) {q.w(n)}, lambda acc, x: x * {a!r} + acc * {1.0 - a!r})")


# W8
@register("ema_window", _sel(f"{_list_ema(5)} AS ema_5, {_list_ema(20)} AS ema_20"),
          BD + ["ema_5", "ema_20"])
def ema_window(spark, sf):
    return finish(ind.ema_window(fx.bars_hourly(spark, sf)))


def _weighted(n: int) -> str:
    lst = f"list(close) {q.w(n)}"
    qv = f"(1 - 2.0 / (len({lst}) + 1))"
    num = f"list_sum(list_transform({lst}, lambda x, i: coalesce(x, 0) * pow({qv}, i - 1)))"
    den = f"list_sum(list_transform({lst}, lambda x, i: pow({qv}, i - 1)))"
    return f"{num} / {den}"


# W9
@register("ema_weighted", _sel(f"{_weighted(5)} AS ema_5, {_weighted(20)} AS ema_20"),
          BD + ["ema_5", "ema_20"])
def ema_weighted(spark, sf):
    return finish(ind.ema_weighted(fx.bars_hourly(spark, sf)))


_GAINS = ("d AS (SELECT *, close - lag(close) " + W + " AS delta FROM b), "
          "g AS (SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0 END AS gain, "
          "CASE WHEN delta < 0 THEN -delta ELSE 0 END AS loss FROM d)")
_AG, _AL = f"avg(gain) {q.w(14)}", f"avg(loss) {q.w(14)}"

# W10
_RSI = (f"CASE WHEN count(gain) {q.w(14)} = 14 THEN CASE WHEN {_AL} = 0 THEN "
        f"CASE WHEN {_AG} > 0 THEN 100.0 ELSE 0.0 END "
        f"ELSE 100 - 100 / (1 + {_AG} / {_AL}) END END")


@register("rsi", _sel(f"{_RSI} AS rsi", "g", _GAINS), BD + ["rsi"])
def rsi(spark, sf):
    return finish(ind.rsi(fx.bars_hourly(spark, sf)))


# W11
_RSI_P = (f"CASE WHEN (CASE WHEN {_AL} <> 0 THEN {_AG} / {_AL} ELSE 0 END) <> 0 "
          f"THEN 100 - 100 / (1 + {_AG} / {_AL}) ELSE 0 END")


@register("rsi_partial", _sel(f"{_RSI_P} AS rsi", "g", _GAINS), BD + ["rsi"])
def rsi_partial(spark, sf):
    return finish(ind.rsi_partial(fx.bars_hourly(spark, sf)))


# W12
_BB = (f"{q.sma('close', 20)} AS bb_middle, {q.sma('close', 20)} + 2 * {q.std('close', 20)} "
       f"AS bb_upper, {q.sma('close', 20)} - 2 * {q.std('close', 20)} AS bb_lower")


@register("bollinger", _sel(_BB), BD + ["bb_middle", "bb_upper", "bb_lower"])
def bollinger(spark, sf):
    return finish(ind.bollinger(fx.bars_hourly(spark, sf)))


# W13
_K = (f"k AS (SELECT *, {q.div('close - lo', 'hi - lo')} * 100 AS k_line FROM "
      f"(SELECT *, {q.full(f'min(low) {q.w(14)}', 'low', 14)} AS lo, "
      f"{q.full(f'max(high) {q.w(14)}', 'high', 14)} AS hi FROM b))")


@register("stochastic", _sel(f"k_line, {q.sma('k_line', 3)} AS d_line", "k", _K),
          BD + ["k_line", "d_line"])
def stochastic(spark, sf):
    return finish(ind.stochastic(fx.bars_hourly(spark, sf)))


# W14
@register("volume_features", _sel(
    f"{q.sma('volume', 5)} AS volume_sma_5, {q.sma('volume', 20)} AS volume_sma_20, "
    f"{q.div('volume', q.sma('volume', 5))} AS volume_ratio"),
    BD + ["volume_sma_5", "volume_sma_20", "volume_ratio"])
def volume_features(spark, sf):
    return finish(ind.volume_features(fx.bars_hourly(spark, sf)))


# W15
@register("volume_ratio_20", _sel(
    f"avg(volume) {q.w(20)} AS volume_ma20, {q.div('volume', f'avg(volume) {q.w(20)}')} "
    "AS volume_ratio"), BD + ["volume_ma20", "volume_ratio"])
def volume_ratio_20(spark, sf):
    return finish(ind.volume_ratio_20(fx.bars_hourly(spark, sf)))


def _macd_cte(src: str = "b", extra_specs=()) -> str:
    """Recursive EMAs incl. MACD and its 9-span signal line."""
    a = {s: 2.0 / (s + 1.0) for s in (5, 12, 20, 26, 9)}
    sp = list(extra_specs)
    init = ", ".join([f"{x} AS {o}" for x, _, o in sp] +
                     ["close AS ema_12", "close AS ema_26", "0.0::DOUBLE AS macd_signal"])
    e12 = f"({a[12]!r} * s.close + {1 - a[12]!r} * r.ema_12)"
    e26 = f"({a[26]!r} * s.close + {1 - a[26]!r} * r.ema_26)"
    step = ", ".join([f"{2.0 / (n + 1.0)!r} * s.{x} + {1 - 2.0 / (n + 1.0)!r} * r.{o}"
                      for x, n, o in sp] +
                     [e12, e26, f"{a[9]!r} * ({e12} - {e26}) + {1 - a[9]!r} * r.macd_signal"])
    outs = ", ".join([o for _, _, o in sp] + ["ema_12", "ema_26", "macd_signal"])
    return f"""
r(series, pos, {outs}) AS (
  SELECT series, pos, {init} FROM {src} WHERE pos = 0
  UNION ALL
  SELECT s.series, s.pos, {step}
  FROM r JOIN {src} AS s ON s.series = r.series AND s.pos = r.pos + 1
)"""


# W16
_MACD_SQL = q.with_bars(
    "SELECT b.series, b.bar_ts, b.open, b.high, b.low, b.close, b.volume, r.ema_12, r.ema_26, "
    "r.ema_12 - r.ema_26 AS macd, r.macd_signal FROM b JOIN r ON r.series = b.series "
    "AND r.pos = b.pos", q.BARS_HOURLY, _macd_cte()).replace("WITH bars AS", "WITH RECURSIVE bars AS")


@register("macd", _MACD_SQL, BD + ["ema_12", "ema_26", "macd", "macd_signal"])
def macd(spark, sf):
    return finish(ind.macd(fx.bars_hourly(spark, sf)))


# W7, W8, W16 over a column with nulls, and a span longer than a chunk's halo
def _null_sql(cols: str, join: str, *ctes: str) -> str:
    return q.with_bars(f"SELECT {', '.join('b.' + c for c in B)}, {cols} FROM b {join}", q.NULL_BARS,
                       ",\n".join(ctes)).replace("WITH bars AS", "WITH RECURSIVE bars AS")


_JOIN_R = "JOIN r ON r.series = b.series AND r.pos = b.pos"


def _null_bars(spark, sf):
    return fx.with_nulls(fx.bars_hourly(spark, sf))


@register("ema_nulls", _null_sql("r.ema_5, r.ema_2000", _JOIN_R, q.ema_nulls(
    "b", "close", {"ema_5": 5, "ema_2000": 2000})), BD + ["ema_5", "ema_2000"])
def ema_nulls(spark, sf):
    return finish(ind.ema(_null_bars(spark, sf), spans=(5, 2000)))


@register("ema_window_nulls", _sel(f"{_list_ema(5).replace('list(close)', 'list(close) FILTER (close IS NOT NULL)')} "
                                   "AS ema_5", bars=q.NULL_BARS), BD + ["ema_5"])
def ema_window_nulls(spark, sf):
    return finish(ind.ema_window(_null_bars(spark, sf)).drop("ema_20"))


@register("macd_nulls", _null_sql(
    "m.ema_12, m.ema_26, m.macd, r2.macd_signal",
    "JOIN m ON m.series = b.series AND m.pos = b.pos JOIN r2 ON r2.series = b.series AND r2.pos = b.pos",
    q.ema_nulls("b", "close", {"ema_12": 12, "ema_26": 26}),
    "m AS (SELECT series, pos, ema_12, ema_26, ema_12 - ema_26 AS macd FROM r)",
    q.ema_nulls("m", "macd", {"macd_signal": 9}, "r2")), BD + ["ema_12", "ema_26", "macd", "macd_signal"])
def macd_nulls(spark, sf):
    return finish(ind.macd(_null_bars(spark, sf)))


_RET = f"rt AS (SELECT *, {q.div('close', PREV)} - 1 AS ret FROM b)"


# W17
@register("daily_volatility", _sel(f"{q.std('ret', 20)} AS daily_volatility", "rt", _RET),
          BD + ["daily_volatility"])
def daily_volatility(spark, sf):
    return finish(ind.daily_volatility(fx.bars_hourly(spark, sf)))


_RET2 = f"rt AS (SELECT *, {q.div(f'close - {PREV}', PREV)} AS returns FROM b)"


# W18
@register("volatility_partial", _sel(f"returns, stddev_samp(returns) {q.w(20)} AS volatility",
                                     "rt", _RET2), BD + ["returns", "volatility"])
def volatility_partial(spark, sf):
    return finish(ind.volatility_partial(fx.bars_hourly(spark, sf)))


_TR = (f"tr AS (SELECT *, greatest(high - low, abs(high - {PREV}), abs(low - {PREV})) AS tr "
       "FROM b)")


# W19
@register("atr", _sel(f"{q.sma('tr', 14)} AS atr", "tr", _TR), BD + ["atr"])
def atr(spark, sf):
    return finish(ind.atr(fx.bars_hourly(spark, sf)))


# W20
@register("momentum", _sel(f"close - lag(close, 20) {W} AS price_momentum"),
          BD + ["price_momentum"])
def momentum(spark, sf):
    return finish(ind.momentum(fx.bars_hourly(spark, sf)))


# W21
def _features_sql(bars: str) -> str:
    ctes = ",\n".join([
        _GAINS, _K.replace("FROM b))", "FROM g))"),
        f"rt AS (SELECT *, {q.div('close', PREV)} - 1 AS ret, "
        f"greatest(high - low, abs(high - {PREV}), abs(low - {PREV})) AS tr FROM k)",
        _macd_cte("b", [("close", 5, "ema_5"), ("close", 20, "ema_20")]),
    ])
    cols = {
        "returns": "ret",
        "log_returns": f"{q.ln('close')} - {q.ln(PREV)}",
        "price_range": "high - low",
        "price_range_pct": q.div("high - low", "close"),
        "sma_5": q.sma("close", 5), "sma_20": q.sma("close", 20),
        "ema_5": "r.ema_5", "ema_20": "r.ema_20", "rsi": _RSI,
        "bb_middle": q.sma("close", 20),
        "bb_upper": f"{q.sma('close', 20)} + 2 * {q.std('close', 20)}",
        "bb_lower": f"{q.sma('close', 20)} - 2 * {q.std('close', 20)}",
        "k_line": "k_line", "d_line": q.sma("k_line", 3),
        "volume_sma_5": q.sma("volume", 5), "volume_sma_20": q.sma("volume", 20),
        "volume_ratio": q.div("volume", q.sma("volume", 5)),
        "macd": "r.ema_12 - r.ema_26", "ema_12": "r.ema_12", "macd_signal": "r.macd_signal",
        "daily_volatility": q.std("ret", 20), "atr": q.sma("tr", 14),
    }
    inner = ", ".join(f"{v} AS {k}" for k, v in cols.items())
    base = ", ".join(f"rt.{c}" for c in B)
    body = f"SELECT {base}, {inner} FROM rt JOIN r USING (series, pos)"
    outer = ", ".join(f"coalesce({k}, 0) AS {k}" for k in cols)
    sql = q.with_bars(f"SELECT {', '.join(B)}, {outer} FROM ({body}) AS f", bars, ctes)
    return sql.replace("WITH bars AS", "WITH RECURSIVE bars AS")


@register("technical_features", _features_sql(q.BARS_HOURLY), BD + ind.FEATURE_COLUMNS)
def technical_features(spark, sf):
    return finish(ind.technical_features(fx.bars_hourly(spark, sf)))


@register("technical_features_daily", _features_sql(q.BARS_DAILY),
          BD + ["volume"] + ind.FEATURE_COLUMNS)
def technical_features_daily(spark, sf):
    return finish(ind.technical_features(fx.bars_daily(spark, sf), DAILY))


# W22
_SX = (f"rt AS (SELECT *, {q.div(f'close - {PREV}', PREV)} AS returns FROM b), "
       f"sx AS (SELECT {', '.join(B)}, returns, stddev_samp(returns) {q.w(20)} AS volatility, "
       f"avg(close) {q.w(20)} AS ma20, avg(volume) {q.w(20)} AS volume_ma20, "
       f"close - lag(close, 20) {W} AS price_momentum, "
       f"{q.div('volume', f'avg(volume) {q.w(20)}')} AS volume_ratio FROM rt)")
_SX_COLS = ["returns", "volatility", "ma20", "volume_ma20", "price_momentum", "volume_ratio"]


@register("sarimax_features", q.with_bars(
    "SELECT * FROM sx WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in B + _SX_COLS),
    q.BARS_HOURLY, _SX), BD + _SX_COLS)
def sarimax_features(spark, sf):
    return finish(ind.sarimax_features(fx.bars_hourly(spark, sf)))


# W23
def _realtime_sql(weighted: bool) -> str:
    e5, e20 = (_weighted(5), _weighted(20)) if weighted else (_list_ema(5), _list_ema(20))
    cols = (f"CASE WHEN {PREV} IS NOT NULL THEN {q.div(f'close - {PREV}', PREV)} ELSE 0 END "
            f"AS returns, CASE WHEN {PREV} IS NOT NULL THEN {q.ln(q.div('close', PREV))} "
            f"ELSE 0 END AS log_returns, high - low AS price_range, "
            f"{q.div('high - low', 'open')} AS price_range_pct, avg(close) {q.w(5)} AS sma_5, "
            f"avg(close) {q.w(20)} AS sma_20, {e5} AS ema_5, {e20} AS ema_20, {_RSI_P} AS rsi")
    return _sel(cols, "g", _GAINS)


@register("realtime_features", _realtime_sql(False), BD + ind.REALTIME_COLUMNS)
def realtime_features(spark, sf):
    return finish(ind.realtime_features(fx.bars_hourly(spark, sf)))


@register("realtime_features_weighted", _realtime_sql(True), BD + ind.REALTIME_COLUMNS)
def realtime_features_weighted(spark, sf):
    return finish(ind.realtime_features(fx.bars_hourly(spark, sf), weighted=True))


@register("build_bars", q.BARS_HOURLY, BD)
def build_bars(spark, sf):
    return finish(fx.bars_hourly(spark, sf))


# S3 at three grains from one scan of the ticks: minutes are kept, hours come from them, days from hours
@register("rolled_bars", " UNION ALL ".join(
    f"SELECT '{g}' AS grain, * FROM ({q.BARS_HOURLY.replace(chr(39) + 'hour' + chr(39), chr(39) + g + chr(39))})"
    for g in ("minute", "hour", "day")), BD)
def rolled_bars(spark, sf):
    minutes = materialize(bar_states(fx.table(spark, sf, "events"), "ts", "value", "event_type", "minute",
                                     ["ts", "event_id"]))
    hours = roll_up(minutes, "hour")
    out = None
    for grain, bars in (("minute", minutes), ("hour", hours), ("day", roll_up(hours, "day"))):
        one = bars.select(F.lit(grain).alias("grain"), *BAR_COLUMNS)
        out = one if out is None else out.unionByName(one)
    return finish(out)


@register("build_bars_daily", q.BARS_DAILY, BD + ["volume"])
def build_bars_daily(spark, sf):
    return finish(fx.bars_daily(spark, sf))


@register("build_bars_orders", q.BARS_ORDERS, BD)
def build_bars_orders(spark, sf):
    return finish(fx.bars_orders(spark, sf))


@register("build_bars_minute", q.BARS_MINUTE, BD)
def build_bars_minute(spark, sf):
    return finish(fx.bars_minute(spark, sf))





# The SQL functions applied to list windows built on the chunked layout
@register("ema_sql_functions", _sel(
    f"{_list_ema(5)} AS ema_5, {_list_ema(20)} AS ema_20, {_weighted(5)} AS wema_5, "
    f"{_weighted(20)} AS wema_20"), BD + ["ema_5", "ema_20", "wema_5", "wema_20"])
def ema_sql_functions(spark, sf):
    from tidemark.functions.exprs import frame
    from tidemark.functions.sql_functions import register as register_sql
    from tidemark.operators.ordered import run_windows
    register_sql(spark)

    def build(f, w):
        f = f.withColumns({"list_5": F.collect_list("close").over(frame(w, 5)),
                           "list_20": F.collect_list("close").over(frame(w, 20))})
        return f.withColumns({
            "ema_5": F.expr("calculate_ema(list_5, 5)"),
            "ema_20": F.expr("calculate_ema(list_20, 20)"),
            "wema_5": F.expr("calculate_ema_weighted(list_5)"),
            "wema_20": F.expr("calculate_ema_weighted(list_20)")}).drop("list_5", "list_20")
    return finish(run_windows(fx.bars_hourly(spark, sf), build, 32, HOURLY))
