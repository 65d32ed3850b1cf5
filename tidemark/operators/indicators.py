"""Technical indicators (W1-W23) as partitioned window queries.

Input: bars ``(series, bar_ts, open, high, low, close, volume)`` unique per
(series, bar_ts).  Every function returns the input columns plus its outputs
and runs one chunked window pass (see ``ordered``); a function with ``*_cols``
in its name is the column builder used by the composites.

Naming: the batch feature set follows the daily feature table (full windows,
``min_periods = n``); the ``*_partial`` / real-time variants start with short
frames at the beginning of a series, as the intraday scoring path does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.exprs import (div, frame, full, safe_log, sma_full, sma_partial,
                                      std_full)
from tidemark.operators import ema as _ema
from tidemark.operators.ema import dbl
from tidemark.operators.ordered import HOURLY, Layout, run_windows


def C():
    return F.col("close")


def O():  # noqa: E743
    return F.col("open")


def H():
    return F.col("high")


def L():
    return F.col("low")


def V():
    return F.col("volume")


# Fixed parameters of the reference's indicators (periods in rows).
SMA_PERIODS = (5, 20)
EMA_SPANS = (5, 20)
RSI_PERIOD = 14
BB_PERIOD, BB_WIDTH = 20, 2.0
STOCH_PERIOD, STOCH_SMOOTH = 14, 3
VOLATILITY_PERIOD = 20
ATR_PERIOD = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
MOMENTUM_LAG = 20

WINDOW_HALO = 32  # longest stacked row frame of the non-recursive indicators (21)
EMA_HALO = _ema.horizon(MACD_SLOW) + _ema.horizon(MACD_SIGNAL)


def _prev(w: WindowSpec, x=None, k: int = 1):
    return F.lag(C() if x is None else x, k).over(w)


# ---------------------------------------------------------------- builders

def returns_cols(w: WindowSpec) -> dict:
    """Pct change, 0 on the first row of a series."""
    return {"returns": F.coalesce(div(C(), _prev(w)) - F.lit(1.0), F.lit(0.0))}


def log_returns_cols(w: WindowSpec) -> dict:
    """Ln c - ln c[-1], 0 on the first row."""
    return {"log_returns": F.coalesce(safe_log(C()) - safe_log(_prev(w)), F.lit(0.0))}


def price_range_cols(base=None) -> dict:
    """W3 (range / close) and W4 (range / open)."""
    base = C() if base is None else base
    return {"price_range": H() - L(), "price_range_pct": div(H() - L(), base)}


def sma_cols(w: WindowSpec, partial: bool = False) -> dict:
    fn = sma_partial if partial else sma_full
    return {f"sma_{n}": fn(C(), w, n) for n in SMA_PERIODS}


def ema_window_expr(w: WindowSpec | str, n: int, x: str = "close"):
    """EMA over the values (not the nulls) of the last n rows, seeded with
    the oldest of them; null if there are none.  ``w`` is the window as SQL text
    (the layout's ``window_sql()``)."""
    a = 2.0 / (n + 1.0)
    values = f"collect_list(CAST(`{x}` AS DOUBLE)) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return F.expr(f"element_at(transform(array({values}), v -> aggregate(slice(v, 2, greatest(size(v) - 1, 0)), "
                  f"get(v, 0), (acc, y) -> y * {dbl(a)} + acc * {dbl(1.0 - a)})), 1)")


def ema_weighted_expr(w: WindowSpec | str, n: int, x: str = "close"):
    """Normalised weights (1-a)^i over the frame, i = 0 the OLDEST value,
    a = 2/(k+1) with k the frame length; nulls count as 0."""
    k = f"count(1) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    q = f"({dbl(1.0)} - {dbl(2.0)} / ({k} + {dbl(1.0)}))"
    num, den = [], []
    for d in range(n):
        lagged = f"`{x}`" if d == 0 else f"lag(`{x}`, {d}) OVER ({w})"
        wt = f"(CASE WHEN {d} < {k} THEN pow({q}, {k} - 1 - {d}) ELSE {dbl(0.0)} END)"
        num.append(f"coalesce({lagged}, {dbl(0.0)}) * {wt}")
        den.append(wt)
    return F.expr(f"({' + '.join(num)}) / ({' + '.join(den)})")


def rsi_expr(w: WindowSpec):
    """Simple-mean RSI on full 14-row frames; no loss -> 100, flat -> 0."""
    delta = C() - _prev(w)
    gain = F.when(delta > 0, delta).otherwise(F.lit(0.0))
    loss = F.when(delta < 0, -delta).otherwise(F.lit(0.0))
    g = F.avg(gain).over(frame(w, RSI_PERIOD))
    lo = F.avg(loss).over(frame(w, RSI_PERIOD))
    n = F.count(gain).over(frame(w, RSI_PERIOD))
    value = (F.when(lo == 0, F.when(g > 0, F.lit(100.0)).otherwise(F.lit(0.0)))
             .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / lo)))
    return F.when(n == RSI_PERIOD, value)


def rsi_partial_expr(w: WindowSpec):
    """Real-time RSI on partial frames; zero average loss -> rs 0 -> RSI 0."""
    delta = C() - _prev(w)
    gain = F.when(delta > 0, delta).otherwise(F.lit(0.0))
    loss = F.when(delta < 0, -delta).otherwise(F.lit(0.0))
    g = F.avg(gain).over(frame(w, RSI_PERIOD))
    lo = F.avg(loss).over(frame(w, RSI_PERIOD))
    rs = F.when(lo != 0, g / lo).otherwise(F.lit(0.0))
    return F.when(rs != 0, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)).otherwise(F.lit(0.0))


def bollinger_cols(w: WindowSpec) -> dict:
    mid = sma_full(C(), w, BB_PERIOD)
    sd = std_full(C(), w, BB_PERIOD)
    return {"bb_middle": mid, "bb_upper": mid + F.lit(BB_WIDTH) * sd,
            "bb_lower": mid - F.lit(BB_WIDTH) * sd}


def stochastic_k_expr(w: WindowSpec):
    lo = full(F.min(L()).over(frame(w, STOCH_PERIOD)), L(), w, STOCH_PERIOD)
    hi = full(F.max(H()).over(frame(w, STOCH_PERIOD)), H(), w, STOCH_PERIOD)
    return div(C() - lo, hi - lo) * F.lit(100.0)


def volume_cols(w: WindowSpec) -> dict:
    return {"volume_sma_5": sma_full(V(), w, 5), "volume_sma_20": sma_full(V(), w, 20)}


def true_range_expr(w: WindowSpec):
    """max(h-l, |h-c[-1]|, |l-c[-1]|) skipping nulls (first row: h-l)."""
    p = _prev(w)
    return F.greatest(H() - L(), F.abs(H() - p), F.abs(L() - p))


# ---------------------------------------------------------------- operators

def _run(df: DataFrame, build, layout: Layout, halo: int = WINDOW_HALO) -> DataFrame:
    return run_windows(df, build, halo, layout)


def returns(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumns(returns_cols(w)), layout)


def log_returns(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumns(log_returns_cols(w)), layout)


def price_range(bars: DataFrame) -> DataFrame:
    return bars.withColumns(price_range_cols(C()))


def price_range_open(bars: DataFrame) -> DataFrame:
    return bars.withColumns(price_range_cols(O()))


def sma(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumns(sma_cols(w)), layout)


def sma_partial_op(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumns(sma_cols(w, partial=True)), layout)


def _gaps(bars: DataFrame, gaps: bool | None, x: str = "close") -> tuple[bool, str | None]:
    """(whether ``x`` has nulls, the column that positions count); None looks."""
    gaps = _ema.has_gaps(bars, x) if gaps is None else gaps
    return gaps, x if gaps else None


def ema(bars: DataFrame, layout: Layout = HOURLY, spans=EMA_SPANS, x: str = "close",
        gaps: bool | None = None) -> DataFrame:
    """W7.  ``gaps``: whether ``x`` holds nulls (None: one aggregation looks)."""
    gaps, count = _gaps(bars, gaps, x)
    halo = max(_ema.horizon(s) for s in spans)
    specs = [(x, s, f"ema_{s}") for s in spans]
    return run_windows(bars, lambda f, w: _ema.ema_columns(f, specs, layout, gaps), halo, layout, count=count)


def ema_window(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumns(
        {f"ema_{n}": ema_window_expr(layout.window_sql(), n) for n in EMA_SPANS}), layout)


def ema_weighted(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumns(
        {f"ema_{n}": ema_weighted_expr(layout.window_sql(), n) for n in EMA_SPANS}), layout)


def rsi(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumn("rsi", rsi_expr(w)), layout)


def rsi_partial(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumn("rsi", rsi_partial_expr(w)), layout)


def bollinger(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumns(bollinger_cols(w)), layout)


def stochastic(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    def build(f, w):
        f = f.withColumn("k_line", stochastic_k_expr(w))
        return f.withColumn("d_line", sma_full("k_line", w, STOCH_SMOOTH))
    return _run(bars, build, layout)


def volume_features(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    def build(f, w):
        f = f.withColumns(volume_cols(w))
        return f.withColumn("volume_ratio", div(V(), "volume_sma_5"))
    return _run(bars, build, layout)


def volume_ratio_20(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    def build(f, w):
        f = f.withColumn("volume_ma20", sma_partial(V(), w, 20))
        return f.withColumn("volume_ratio", div(V(), "volume_ma20"))
    return _run(bars, build, layout)


def macd(bars: DataFrame, layout: Layout = HOURLY, gaps: bool | None = None) -> DataFrame:
    """W16.  ``gaps`` as for ``ema``."""
    gaps, count = _gaps(bars, gaps)

    def build(f, w):
        f = _ema.ema_columns(f, [("close", MACD_FAST, "ema_12"), ("close", MACD_SLOW, "ema_26")],
                             layout, gaps)
        f = f.withColumn("macd", F.col("ema_12") - F.col("ema_26"))
        return _ema.ema_columns(f, [("macd", MACD_SIGNAL, "macd_signal")], layout, gaps,
                                _ema.horizon(MACD_SLOW))
    return run_windows(bars, build, EMA_HALO, layout, count=count)


def _pct_raw(w):
    return div(C(), _prev(w)) - F.lit(1.0)


def daily_volatility(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    def build(f, w):
        f = f.withColumn("_ret", _pct_raw(w))
        return f.withColumn("daily_volatility", std_full("_ret", w, VOLATILITY_PERIOD))
    return _run(bars, build, layout)


def volatility_partial(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    def build(f, w):
        f = f.withColumn("returns", div(C() - _prev(w), _prev(w)))
        return f.withColumn("volatility", F.stddev_samp("returns").over(frame(w, 20)))
    return _run(bars, build, layout)


def atr(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    def build(f, w):
        f = f.withColumn("_tr", true_range_expr(w))
        return f.withColumn("atr", sma_full("_tr", w, ATR_PERIOD))
    return _run(bars, build, layout)


def momentum(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    return _run(bars, lambda f, w: f.withColumn("price_momentum", C() - _prev(w, C(), MOMENTUM_LAG)),
                layout)


# ---------------------------------------------------------------- composites

# The columns of the feature table, in its order.  ``ema_12`` here is the
# 12-span EMA; the reference stores MACD under that name.
FEATURE_COLUMNS = [
    "returns", "log_returns", "price_range", "price_range_pct", "sma_5", "sma_20",
    "ema_5", "ema_20", "rsi", "bb_middle", "bb_upper", "bb_lower", "k_line", "d_line",
    "volume_sma_5", "volume_sma_20", "volume_ratio", "macd", "ema_12", "macd_signal",
    "daily_volatility", "atr",
]


def technical_features(bars: DataFrame, layout: Layout = HOURLY,
                       fill_zero: bool = True, gaps: bool | None = None) -> DataFrame:
    """The 22 feature columns of the daily feature table in one plan.

    ``fill_zero`` reproduces the table's final null -> 0 step; with False the
    warm-up rows stay null (better input for correlations and models).
    ``ema_12`` is the true 12-span EMA (the source table stored MACD there).
    ``gaps``: whether closes may be null; None looks with one aggregation (persist
    bars that are costly to build).
    """
    gaps, count = _gaps(bars, gaps)

    def build(f, w):
        f = f.withColumns({
            "_ret": _pct_raw(w),
            "_tr": true_range_expr(w),
            "k_line": stochastic_k_expr(w),
            "log_returns": safe_log(C()) - safe_log(_prev(w)),
            **price_range_cols(C()),
            **sma_cols(w),
            "rsi": rsi_expr(w),
            **bollinger_cols(w),
            **volume_cols(w),
        })
        f = f.withColumns({
            "returns": F.col("_ret"),
            "d_line": sma_full("k_line", w, STOCH_SMOOTH),
            "volume_ratio": div(V(), "volume_sma_5"),
            "daily_volatility": std_full("_ret", w, VOLATILITY_PERIOD),
            "atr": sma_full("_tr", w, ATR_PERIOD),
        })
        f = _ema.ema_columns(f, [("close", 5, "ema_5"), ("close", 20, "ema_20"),
                                 ("close", MACD_FAST, "ema_12"), ("close", MACD_SLOW, "_ema_26")],
                             layout, gaps)
        f = f.withColumn("macd", F.col("ema_12") - F.col("_ema_26"))
        return _ema.ema_columns(f, [("macd", MACD_SIGNAL, "macd_signal")], layout, gaps,
                                _ema.horizon(MACD_SLOW))

    out = run_windows(bars, build, EMA_HALO, layout, count=count)
    base = [c for c in bars.columns]
    out = out.select(*base, *FEATURE_COLUMNS)
    return fill_zero_op(out, FEATURE_COLUMNS) if fill_zero else out


def fill_zero_op(df: DataFrame, cols=None) -> DataFrame:
    """Null / NaN -> 0 in the given (default: all numeric) columns."""
    from pyspark.sql.types import DoubleType, FloatType, NumericType
    types = {f.name: f.dataType for f in df.schema.fields}  # one schema round trip
    cols = cols or [c for c, t in types.items() if isinstance(t, NumericType)]
    fixed = {}
    for c in cols:
        v = F.col(c)
        if isinstance(types[c], (DoubleType, FloatType)):
            v = F.nanvl(v, F.lit(None))
        fixed[c] = F.coalesce(v, F.lit(0)).cast(types[c])
    return df.withColumns(fixed)


def sarimax_features(bars: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    """Returns, 20-row volatility/MA/volume MA (partial), volume ratio,
    20-row momentum; rows with any null dropped (the first 20 of a series)."""
    def build(f, w):
        f = f.withColumn("returns", div(C() - _prev(w), _prev(w)))
        f = f.withColumns({
            "volatility": F.stddev_samp("returns").over(frame(w, 20)),
            "ma20": sma_partial(C(), w, 20),
            "volume_ma20": sma_partial(V(), w, 20),
            "price_momentum": C() - _prev(w, C(), MOMENTUM_LAG),
        })
        return f.withColumn("volume_ratio", div(V(), "volume_ma20"))
    return _run(bars, build, layout).na.drop()


# The columns of the intraday scoring path, in its order.
REALTIME_COLUMNS = ["returns", "log_returns", "price_range", "price_range_pct", "sma_5",
                    "sma_20", "ema_5", "ema_20", "rsi"]


def realtime_features(bars: DataFrame, layout: Layout = HOURLY, weighted: bool = False) -> DataFrame:
    """The nine indicator columns of the intraday scoring path.

    ``weighted`` picks the normalised-weight EMA (W9) instead of the
    window-seeded EMA (W8).
    """
    ema_fn = ema_weighted_expr if weighted else ema_window_expr

    def build(f, w):
        p = _prev(w)
        return f.withColumns({
            "returns": F.when(p.isNotNull(), div(C() - p, p)).otherwise(F.lit(0.0)),
            "log_returns": F.when(p.isNotNull(), safe_log(div(C(), p))).otherwise(F.lit(0.0)),
            **price_range_cols(O()),
            **sma_cols(w, partial=True),
            "ema_5": ema_fn(layout.window_sql(), 5),
            "ema_20": ema_fn(layout.window_sql(), 20),
            "rsi": rsi_partial_expr(w),
        })
    return _run(bars, build, layout)
