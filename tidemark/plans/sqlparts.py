"""DuckDB SQL building blocks for the oracle twins of the registered queries.

Written independently of the Spark plans: plain whole-series windows, a
recursive CTE for the exponential averages, list reductions for the
window-seeded averages.
"""

from __future__ import annotations

BARS_HOURLY = """
SELECT event_type AS series, date_trunc('hour', ts) AS bar_ts,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY 1, 2"""

BARS_MINUTE = BARS_HOURLY.replace("'hour'", "'minute'")

BARS_ORDERS = """
SELECT o_orderpriority AS series, date_trunc('day', o_orderdate) AS bar_ts,
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
       count(*) AS volume
FROM orders GROUP BY 1, 2"""

_LI_KEY = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
BARS_DAILY = f"""
SELECT l_returnflag AS series, date_trunc('day', l_shipdate) AS bar_ts,
       arg_min(l_extendedprice / l_quantity, {_LI_KEY}) AS open,
       max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
       arg_max(l_extendedprice / l_quantity, {_LI_KEY}) AS close,
       sum(l_quantity) AS volume
FROM lineitem GROUP BY 1, 2"""

BAR_COLS = ["open", "high", "low", "close"]


def w(n: int | None = None, part: str = "series", order: str = "bar_ts") -> str:
    """OVER clause: whole history (n None) or the last n rows."""
    frame = "" if n is None else f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
    return f"OVER (PARTITION BY {part} ORDER BY {order}{frame})"


# bars with close nulled where the row position % 7 < 3 (edge fixture)
NULL_BARS = (f"SELECT series, bar_ts, open, high, low, CASE WHEN (row_number() {w()} - 1) % 7 < 3 "
             f"THEN NULL ELSE close END AS close, volume FROM ({BARS_HOURLY})")


# bars without the series 'click', and without the time stamp of each series' last bar
NULL_KEY_BARS = (f"SELECT nullif(series, 'click') AS series, CASE WHEN bar_ts < max(bar_ts) OVER (PARTITION BY series) "
                 f"THEN bar_ts END AS bar_ts, open, high, low, close, volume FROM ({BARS_HOURLY})")


def div(n: str, d: str) -> str:
    return f"(({n}) / NULLIF(({d}), 0))"


def full(value: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) {w(n)} = {n} THEN {value} END"


def sma(x: str, n: int) -> str:
    return full(f"avg({x}) {w(n)}", x, n)


def std(x: str, n: int) -> str:
    return full(f"stddev_samp({x}) {w(n)}", x, n)


def ln(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ln({x}) END)"


def rounded(core: str, doubles: list[str], digits: int = 6) -> str:
    """Round the listed double columns like the Spark side does."""
    if not doubles:
        return core
    k = f"{float(10 ** digits)!r}::DOUBLE"
    rep = ", ".join(f"round({c} * {k}) / {k} + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({core}) AS _t"


def with_bars(body: str, bars: str = BARS_HOURLY, extra: str = "") -> str:
    """``bars`` and ``b`` (bars + 0-based position) CTEs in front of ``body``."""
    more = f",\n{extra}" if extra else ""
    return (f"WITH bars AS ({bars}),\n"
            f"b AS (SELECT *, row_number() {w()} - 1 AS pos FROM bars){more}\n{body}")


def ema_recursive(src: str, specs: list[tuple[str, float, str]], keep: list[str]) -> str:
    """Recursive CTE body computing EMAs (pandas adjust=False) per series.

    src: relation with series, pos and the input columns; specs = (input,
    span, output).  Returns a SELECT of keep + outputs.
    """
    init = ", ".join(f"{x} AS {o}" for x, _, o in specs)  # inputs without nulls
    step = ", ".join(
        f"{2.0 / (s + 1.0)!r} * s.{x} + {1.0 - 2.0 / (s + 1.0)!r} * r.{o}" for x, s, o in specs)
    outs = ", ".join(o for _, _, o in specs)
    return f"""
r(series, pos, {outs}) AS (
  SELECT series, pos, {init} FROM {src} WHERE pos = 0
  UNION ALL
  SELECT s.series, s.pos, {step}
  FROM r JOIN {src} AS s ON s.series = r.series AND s.pos = r.pos + 1
)"""


def ema_nulls(src: str, x: str, spans: dict[str, float], name: str = "r") -> str:
    """Recursive CTE of EMAs over a column with nulls (pandas adjust=False,
    ignore_na=False): a null keeps the value and lets its weight decay."""
    outs = list(spans)
    step, init = [], []
    for o, s in spans.items():
        a = 2.0 / (s + 1.0)
        q = 1.0 - a
        init += [f"{x}::DOUBLE AS {o}", f"1.0::DOUBLE AS w_{o}"]
        step += [f"CASE WHEN s.{x} IS NULL THEN r.{o} WHEN r.{o} IS NULL THEN s.{x} ELSE "
                 f"({q!r} * r.w_{o} * r.{o} + {a!r} * s.{x}) / ({q!r} * r.w_{o} + {a!r}) END",
                 f"CASE WHEN s.{x} IS NULL THEN {q!r} * r.w_{o} ELSE 1.0 END"]
    cols = ", ".join(f"{o}, w_{o}" for o in outs)
    return f"""
{name}(series, pos, {cols}) AS (
  SELECT series, pos, {", ".join(init)} FROM {src} WHERE pos = 0
  UNION ALL
  SELECT s.series, s.pos, {", ".join(step)}
  FROM {name} AS r JOIN {src} AS s ON s.series = r.series AND s.pos = r.pos + 1
)"""
