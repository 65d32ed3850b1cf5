"""Recursive exponential moving average as a blocked scan.

y_0 = x_0, y_i = alpha * x_i + q * y_{i-1}, q = 1 - alpha, alpha = 2/(span+1)
(pandas ``ewm(span, adjust=False)``).  A null keeps the value; the next
observation, g rows after the last, weighs the old value with q^g:
y_i = (q^g y + alpha x_i) / (q^g + alpha), as pandas does.

Spark has no recursive window, but the recurrence y_i = A_i y + C_i x_i is
linear, so it splits into blocks of adjoining observations, cut where the decay
-ln A since the chunk's start passes multiples of ``_DECAY``:

* F_i = product of A in the block up to i, as q^n exp(-d): n plain steps, d the
  logarithms of the steps over gaps;
* value with zero carry: loc_i = F_i * sum_{j<=i} C_j x_j / F_j;
* y_i = loc_i + F_i * E, E the value at the end of the block before.  E needs no
  carry of its own: over a whole block it decays below 1e-17.

Where inputs hold no nulls, blocks are runs of positions that all spans share, and
one sort serves all of them (``even_columns``).  With nulls,
windows run over ``partitionBy(series, chunk, is null)``, the chunk's own
shuffle with another sort.  Rows without an observation take the last y.
Chunks must be cut by observations (``with_halo(count=x)``): then
``horizon(span)`` halo positions make a chunk exact to 1e-17.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import CHUNK, POS, Layout

_EPS = 1e-17
#: Decay (as a negative logarithm) of a block; exp of it must be a double.
_DECAY = 80.0
#: Largest decay of a block of even positions.
_RANGE = 600.0
#: Most that one step counts; beyond it the old value is below _EPS anyway.
_STEP = 40.0


def alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def horizon(span: float) -> int:
    """Observations after which an earlier start changes y by < 1e-17·|x|."""
    q = 1.0 - alpha(span)
    return 1 if q <= 0.0 else math.ceil(math.log(_EPS) / math.log(q)) + 1


def dbl(v: float) -> str:
    """An exact DOUBLE literal in SQL text (plain decimals would parse as DECIMAL)."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def has_gaps(df: DataFrame, column: str) -> bool:
    """Whether rows lack ``column`` (one aggregation; a cached frame is then in use)."""
    return bool(df.agg(F.coalesce(F.max(F.col(column).isNull()), F.lit(False))).first()[0])


def _even_groups(specs: Sequence[tuple[str, float, str]], least: int) -> list[tuple[int, list]]:
    """(rows of a block, specs): blocks as long as the longest horizon (or ``least``),
    with powers of the fastest decay over a block in a double's range."""
    out: list[tuple[int, list]] = []
    for spec in sorted(specs, key=lambda s: -s[1]):
        q = 1.0 - alpha(spec[1])
        if out and q > 0.0 and -math.log(q) * out[-1][0] <= _RANGE:
            out[-1][1].append(spec)
        else:
            size = horizon(spec[1])
            if size < least and (q <= 0.0 or -math.log(q) * least <= _RANGE):
                size = least
            out.append((size, [spec]))
    return out


def even_columns(framed: DataFrame, specs: Sequence[tuple[str, float, str]], layout: Layout,
                 least: int = 0) -> DataFrame:
    """EMA columns of inputs without nulls: blocks are runs of positions, the same
    for all spans, so that every window of all of them has one order of rows and
    the frame is sorted once.  A block's end value decays below 1e-17 over the next
    block, so it only reaches one block on."""
    df, outs, blocks = framed, {}, []
    for size, group in _even_groups(specs, least):
        block, n = f"_e{size}", f"pmod(`{POS}`, {size})"
        if block not in df.columns:  # a later call on the result finds the same order of rows
            df = df.withColumn(block, F.expr(f"`{POS}` div {size}"))
            blocks.append(block)
        order = f"`{POS}`, `{layout.ts}` NULLS LAST"
        inside = (f"PARTITION BY `{layout.series}`, `{CHUNK}`, `{block}` ORDER BY {order} "
                  "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
        along = f"PARTITION BY `{layout.series}`, `{CHUNK}` ORDER BY `{block}`, {order}"
        loc, end, last = {}, {}, {}
        for x, span, out in group:
            a, v = alpha(span), f"CAST(`{x}` AS DOUBLE)"
            q = 1.0 - a
            if q <= 0.0:
                outs[out] = F.expr(v)
                continue
            first = f"CASE WHEN `{POS}` = 0 THEN {v} ELSE {dbl(a)} * {v} END"
            loc[f"_loc_{out}"] = F.expr(f"pow({dbl(q)}, {n}) * sum(({first}) * pow({dbl(q)}, -{n})) OVER ({inside})")
            end[f"_end_{out}"] = F.expr(f"CASE WHEN lead(`{block}`) OVER ({along}) <> `{block}` THEN `_loc_{out}` END")
            last[f"_last_{out}"] = F.expr(
                f"last(`_end_{out}`, true) OVER ({along} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
            outs[out] = F.expr(f"`_loc_{out}` + pow({dbl(q)}, {n} + 1) * coalesce(`_last_{out}`, {dbl(0.0)})")
        for stage in (loc, end, last):
            df = df.withColumns(stage) if stage else df
    keep = [c for c in framed.columns if c not in outs] + blocks
    return df.select(*keep, *[v.alias(k) for k, v in outs.items()])


def ema_columns(framed: DataFrame, specs: Sequence[tuple[str, float, str]],
                layout: Layout, gaps: bool = True, least: int = 0) -> DataFrame:
    """Add EMA columns to a framed (position + chunk) DataFrame; without ``gaps``
    no input may hold nulls (see ``even_columns``; ``least``: rows of a block that
    another call has sorted by).

    ``specs`` = [(input column, span, output column)].  The frame's halo must
    hold ``horizon(span)`` observations.  Rows before the first observation get
    null.  Expressions are generated as SQL text: one parse per column instead
    of hundreds of driver round trips.
    """
    if not gaps:
        return even_columns(framed, specs, layout, least)
    w = layout.window_sql()
    order = w[w.index("ORDER BY"):]
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    df = framed.withColumn("_row", F.expr(f"row_number() OVER ({w})"))
    inputs = list(dict.fromkeys(x for x, _, _ in specs))
    wo = {x: f"PARTITION BY `{layout.series}`, `{CHUNK}`, (`{x}` IS NULL) {order}" for x in inputs}
    df = df.withColumns({f"_i_{x}": F.expr(f"row_number() OVER ({wo[x]}) - 1") for x in inputs}
                        | {f"_g_{x}": F.expr(f"`_row` - lag(`_row`) OVER ({wo[x]})") for x in inputs})
    stages: list[dict] = [{} for _ in range(6)]
    outs = {}
    for x, span, out in specs:
        a = alpha(span)
        q = 1.0 - a
        v, i, g = f"CAST(`{x}` AS DOUBLE)", f"`_i_{x}`", f"`_g_{x}`"
        last = f"last(%s, true) OVER ({w} {upto})"
        if q <= 0.0:
            outs[out] = F.expr(last % v)
            continue
        plain = f"(coalesce({g}, 1) = 1)"
        over = f"(pow({dbl(q)}, {g}) + {dbl(a)})"
        decay = f"least({dbl(_STEP)}, ln({over}) - {g} * {dbl(math.log(q))})"
        wsub = f"PARTITION BY `{layout.series}`, `{CHUNK}`, (`{x}` IS NULL), `_b_{out}` {order}"
        # in a block powers count from its first observation, so that this one is taken as it is
        factor = f"pow({dbl(q)}, %s(`_n_{out}` - 1)) * exp(%s`_d_{out}`)"
        carried = f"pow({dbl(q)}, `_n_{out}`) * exp(-`_d_{out}`)"
        c = (f"CASE WHEN `{CHUNK}` = 0 AND {i} = 0 THEN {v} WHEN {plain} THEN {dbl(a)} * {v} "
             f"ELSE {dbl(a)} / {over} * {v} END")
        for stage, column in zip(stages, (
            {"b": f"floor(sum(CASE WHEN {plain} THEN {dbl(-math.log(q))} ELSE {decay} END) OVER ({wo[x]} {upto}) "
                  f"/ {dbl(_DECAY)})"},
            {"n": f"sum(CASE WHEN {plain} THEN 1 ELSE 0 END) OVER ({wsub} {upto})",
             "d": f"sum(CASE WHEN {plain} THEN {dbl(0.0)} ELSE {decay} END) OVER ({wsub} {upto})"},
            {"loc": f"{factor % ('', '-')} * sum(({c}) * {factor % ('-', '')}) OVER ({wsub} {upto})"},
            {"end": f"CASE WHEN lead(`_b_{out}`) OVER ({wo[x]}) <> `_b_{out}` THEN `_loc_{out}` END"},
            {"prev": f"last(`_end_{out}`, true) OVER ({wo[x]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"},
            {"y": f"CASE WHEN `{x}` IS NOT NULL THEN `_loc_{out}` + coalesce(`_prev_{out}`, {dbl(0.0)}) * "
                  f"{carried} END"},
        ), strict=True):
            stage.update({f"_{k}_{out}": F.expr(e) for k, e in column.items()})
        outs[out] = F.expr(last % f"`_y_{out}`")
    if outs and stages[0]:
        df = df.withColumns(stages[0])
        for _, _, out in specs:  # one after the other: both stages of a block share its sort
            for stage in stages[1:3]:
                own = {k: v for k, v in stage.items() if k in (f"_n_{out}", f"_d_{out}", f"_loc_{out}")}
                df = df.withColumns(own) if own else df
        for stage in stages[3:]:
            df = df.withColumns(stage) if stage else df
    keep = [c for c in framed.columns if c not in outs]
    return df.select(*keep, *[v.alias(k) for k, v in outs.items()])
