"""Conditional sum of squares of a seasonal ARMA for many series (F3, last stage).

    phi(L) Phi(L^s) w_t = theta(L) Theta(L^s) e_t

Parameters are the factors' own coefficients, so the coefficient of a cross lag is
the product of two.  With z = w / (theta Theta) and v = e / (theta Theta) (filters
that start at zero), e = phi Phi z, and the derivatives of e are finite lags of z
and v:

    by phi_i:  -Phi(L^s) z_{t-i}        by Phi_j:   -phi(L) z_{t-sj}
    by theta_i: -Theta(L^s) v_{t-i}     by Theta_j: -theta(L) v_{t-sj}

z and v are one linear recursion.  Its state, the last few z and v, links blocks of
adjoining rows: every block is run from state zero, its end state and the power of
the companion matrix chain the blocks of a series (one small row for each block),
and every block is run again from its true state and reduced to cross products.
All blocks of a batch step together in numpy; rows are shuffled once, when they are
packed into blocks.  Gauss-Newton steps with a Levenberg factor use sums per series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import join_on
from tidemark.operators import ordered
from tidemark.operators.ordered import POS, Layout
from tidemark.session import materialize

#: Rows of a block, and evaluations after the first.
BLOCK = 2048
STEPS = 6
#: Largest root modulus of a factor (1 is the unit root).
ROOT = 0.99


def pack(w: DataFrame, longest: int, layout: Layout, block: int = BLOCK) -> DataFrame:
    """``series, block, rows``: the rows ``(pos, bar_ts, y, w, ok)`` of a block in
    order; ``ok``: w and its ``longest`` lags are there, so e counts."""
    def build(f, wdw):
        return f.withColumn("ok", F.count("w").over(wdw.rowsBetween(-longest, 0)) == longest + 1)
    rows = ordered.run_windows(w, build, longest + 1, layout, keep_pos=True)
    return rows.groupBy("series", F.floor(F.col(POS) / block).alias("block")).agg(F.sort_array(F.collect_list(
        F.struct(F.col(POS).alias("pos"), "bar_ts", "y", "w", "ok"))).alias("rows"))


class Shape:
    """Which lags belong to which factor."""

    def __init__(self, order):
        s = order.s
        self.small_ar, self.big_ar = list(range(1, order.p + 1)), [s * j for j in range(1, order.P + 1)]
        self.small_ma, self.big_ma = list(range(1, order.q + 1)), [s * j for j in range(1, order.Q + 1)]
        self.lags = [self.small_ar, self.big_ar, self.small_ma, self.big_ma]
        self.cut = np.cumsum([0, *[len(x) for x in self.lags]])
        self.params = int(self.cut[-1])
        self.ar_lags, self.ma_lags = order.ar_lags(), order.ma_lags()
        self.nz = max(self.ar_lags + self.ma_lags, default=0)  # lags of z and v that are used
        self.state = 2 * self.nz

    def factors(self, theta: np.ndarray) -> list[np.ndarray]:
        """Polynomials (n x lags + 1, ascending) of the four factors; those of
        the AR side with a minus."""
        out = []
        for k, lags in enumerate(self.lags):
            f = np.zeros((len(theta), max(lags, default=0) + 1))
            f[:, 0] = 1.0
            for m, lag in enumerate(lags):
                f[:, lag] = (-1 if k < 2 else 1) * theta[:, self.cut[k] + m]
            out.append(f)
        return out

    def shrunk(self, theta: np.ndarray) -> np.ndarray:
        """Coefficients with every factor's roots inside ``ROOT``."""
        out = theta.copy()
        for k, lags in enumerate(self.lags):
            step = lags[0] if lags else 1
            for m in range(2 if lags and len(lags) > 1 else 1):
                if not lags:
                    break
                own = slice(self.cut[k], self.cut[k + 1])
                roots = np.abs(np.roots([1.0, *((-1 if k < 2 else 1) * out[own])]))
                worst = max(roots, default=0.0) ** (1 / step)
                if worst > ROOT:
                    out[own] *= (ROOT / worst) ** np.array(lags)
        return out

    def from_lags(self, beta: Sequence[float]) -> np.ndarray:
        """Factors' coefficients out of free coefficients by lag."""
        free = [dict(zip(self.ar_lags, beta, strict=False)),
                dict(zip(self.ma_lags, list(beta)[len(self.ar_lags):], strict=False))]
        return self.shrunk(np.array([free[k // 2].get(lag, 0.0) for k, lags in enumerate(self.lags) for lag in lags]))

    def by_lag(self, theta: np.ndarray) -> tuple[list[float], list[float]]:
        """Coefficients of the multiplied polynomials on ``ar_lags``, ``ma_lags``."""
        f = [x[0] for x in self.factors(theta[None, :])]
        ar, ma = np.convolve(f[0], f[1]), np.convolve(f[2], f[3])
        return [float(-ar[k]) for k in self.ar_lags], [float(ma[k]) for k in self.ma_lags]


def _times(f: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Row-wise products of polynomials."""
    out = np.zeros((len(f), f.shape[1] + g.shape[1] - 1))
    for k in range(g.shape[1]):
        out[:, k: k + f.shape[1]] += f * g[:, k: k + 1]
    return out


def _step_rows(shape: Shape, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """z_t = w_t + a . state and v_t = w_t + b . state, state = last z, last v."""
    f, k = shape.factors(theta), shape.nz
    ar, ma = _times(f[0], f[1])[:, 1:], _times(f[2], f[3])[:, 1:]
    a, b = np.zeros((len(theta), 2 * k)), np.zeros((len(theta), 2 * k))
    a[:, :ma.shape[1]] = -ma  # z = w - ma z
    b[:, :ma.shape[1]] = -ma  # e = z + ar z (lags) and v = e - ma v
    b[:, :ar.shape[1]] += ar
    b[:, k: k + ma.shape[1]] = -ma
    return a, b


def companion(shape: Shape, theta: np.ndarray) -> np.ndarray:
    """State after a row without w (n x state x state)."""
    a, b = _step_rows(shape, theta)
    k = shape.nz
    out = np.zeros((len(theta), 2 * k, 2 * k))
    if k:
        out[:, 0], out[:, k] = a, b
        for r in range(1, k):
            out[:, r, r - 1] = out[:, k + r, k + r - 1] = 1.0
    return out


def run_blocks(shape: Shape, theta: np.ndarray, w: np.ndarray, state: np.ndarray):
    """z and v (blocks x nz + rows, the state's lags first) of blocks of w."""
    a, b = _step_rows(shape, theta)
    n, k = len(w), shape.nz
    z, v = np.zeros((n, k + w.shape[1])), np.zeros((n, k + w.shape[1]))
    z[:, :k], v[:, :k] = state[:, :k][:, ::-1], state[:, k:][:, ::-1]
    az, bz, bv = a[:, :k][:, ::-1], b[:, :k][:, ::-1], b[:, k:][:, ::-1]
    for t in range(w.shape[1]):
        last = z[:, t: t + k]
        z[:, k + t] = w[:, t] + (az * last).sum(axis=1)
        v[:, k + t] = w[:, t] + (bz * last).sum(axis=1) + (bv * v[:, t: t + k]).sum(axis=1)
    return z, v


def _lagged(x: np.ndarray, poly: np.ndarray, shift: int, k: int, rows: int) -> np.ndarray:
    """sum of poly_i x_{t-shift-i}; lags before the state's count as zero."""
    out = np.zeros((len(x), rows))
    for i in range(poly.shape[1]):
        lag = shift + i
        if lag <= k:
            out += poly[:, i: i + 1] * x[:, k - lag: k - lag + rows]
    return out


def residuals(shape: Shape, theta: np.ndarray, z: np.ndarray, rows: int) -> np.ndarray:
    f = shape.factors(theta)
    return _lagged(z, _times(f[0], f[1]), 0, shape.nz, rows)


def slopes(shape: Shape, theta: np.ndarray, z: np.ndarray, v: np.ndarray, rows: int) -> np.ndarray:
    """Derivatives of e by the parameters (blocks x rows x params)."""
    f, out = shape.factors(theta), []
    for k, lags in enumerate(shape.lags):
        other, x = f[k ^ 1], z if k < 2 else v
        out += [-_lagged(x, other, lag, shape.nz, rows) for lag in lags]
    return np.stack(out, axis=2) if out else np.zeros((len(z), rows, 0))


# ------------------------------------------------------------------ Spark

def _unpacked(pdf: pd.DataFrame):
    """(w, ok) of a batch's blocks, padded at the end; a missing w counts as 0."""
    size = [len(r) for r in pdf["rows"]]
    w, ok = np.zeros((len(size), max(size))), np.zeros((len(size), max(size)), bool)
    for i, rows in enumerate(pdf["rows"]):
        w[i, :size[i]] = [r["w"] for r in rows]
        ok[i, :size[i]] = [r["ok"] for r in rows]
    return np.nan_to_num(w), ok, np.array(size)


def _slim(blocks: DataFrame) -> DataFrame:
    return blocks.select("series", "block", F.transform("rows", lambda r: F.struct(
        F.coalesce(r["w"], F.lit(0.0)).alias("w"), r["ok"].alias("ok"))).alias("rows"))


def _start_states(blocks: DataFrame, theta: DataFrame, shape: Shape, block: int) -> DataFrame:
    """``series, block, state``: the state before each block."""
    def ends(batches):
        for pdf in batches:
            if len(pdf):
                w, _, size = _unpacked(pdf)
                p = np.stack(pdf["theta"]).reshape(len(pdf), -1)
                z, v = run_blocks(shape, p, w, np.zeros((len(pdf), shape.state)))
                k = shape.nz
                at = size[:, None] + np.arange(k)[::-1]
                own = np.arange(len(pdf))[:, None]
                end = np.concatenate([z[own, at], v[own, at]], axis=1)
                yield pd.DataFrame({"series": pdf["series"], "block": pdf["block"], "theta": pdf["theta"],
                                    "end": list(end)})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        m = companion(shape, np.array(pdf["theta"].iloc[0], float).reshape(1, -1))[0]
        power, state, out, last = np.linalg.matrix_power(m, block), np.zeros(shape.state), [], None
        for b, end in zip(pdf["block"], pdf["end"], strict=True):
            for _ in range(0 if last is None else int(b - last) - 1):
                state = power @ state  # blocks without rows
            out.append(state)
            state, last = power @ state + end, b
        return pd.DataFrame({"series": pdf["series"], "block": pdf["block"], "state": out})

    found = join_on(_slim(blocks), theta, "series").mapInPandas(
        ends, "series string, block long, theta array<double>, end array<double>")
    return found.groupBy("series").applyInPandas(chain, "series string, block long, state array<double>")


def _sums(blocks: DataFrame, theta: DataFrame, shape: Shape, block: int) -> DataFrame:
    """``series, cells, n``: J'J, J'e and e'e of every series at its theta, as a
    flat array in the order of the upper triangle of [J e]."""
    i, j = np.triu_indices(shape.params + 1)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                w, ok, _ = _unpacked(pdf)
                p = np.stack(pdf["theta"]).reshape(len(pdf), -1)
                z, v = run_blocks(shape, p, w, np.stack(pdf["state"]).reshape(len(pdf), -1))
                rows = w.shape[1]
                x = np.concatenate([slopes(shape, p, z, v, rows), residuals(shape, p, z, rows)[:, :, None]], axis=2)
                x = x * ok[:, :, None]
                cells = np.einsum("btp,btq->bpq", x, x)[:, i, j]
                yield pd.DataFrame({"series": np.repeat(pdf["series"].to_numpy(), len(i)),
                                    "cell": np.tile(np.arange(len(i)), len(pdf)), "s": cells.ravel(),
                                    "n": np.repeat(ok.sum(axis=1), len(i))})

    states = _start_states(blocks, theta, shape, block)
    found = join_on(join_on(_slim(blocks), states, ["series", "block"]), theta, "series").mapInPandas(
        run, "series string, cell int, s double, n long")
    cells = found.groupBy("series", "cell").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return cells.groupBy("series").agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "s"))),
                                                   lambda c: c["s"]).alias("cells"), F.max("n").alias("n"))


_SEARCH = ("series string, theta array<double>, best array<double>, sse double, cells array<double>, damping double, "
           "n long, done boolean")


def _move(shape: Shape):
    """A Levenberg step of every series: keep the trial if it is better, else go
    back with more damping."""
    i, j = np.triu_indices(shape.params + 1)

    def step(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                trial, cells = np.array(r.theta, float), np.array(r.found, float)
                sse, damping, best, held, before = cells[-1], r.damping, r.best, r.cells, r.sse
                if best is None or sse <= before:
                    gain = np.inf if best is None else before - sse
                    done = gain <= 1e-10 * max(before, 1e-300) if best is not None else False
                    best, held, before, damping = trial, cells, sse, damping / 4
                else:
                    damping, done = damping * 8, damping > 1e6
                best = np.array(best, float)
                m = np.zeros((shape.params + 1,) * 2)
                m[i, j] = m[j, i] = held
                jj, je = m[:-1, :-1], m[:-1, -1]
                ridge = damping * np.diag(np.maximum(np.diag(jj), 1e-300))
                move = np.linalg.lstsq(jj + ridge, -je, rcond=None)[0] if shape.params else np.zeros(0)
                out.append((r.series, shape.shrunk(best + move).tolist(), best.tolist(), float(before),
                            list(map(float, held)), float(damping), int(r.found_n), bool(done or not shape.params)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in _SEARCH.split(", ")])
    return step


def fit(blocks: DataFrame, start: DataFrame, order, steps: int = STEPS, block: int = BLOCK):
    """(model, frame) as ``forecast.sarima_fit`` returns them, from packed rows and
    ``start`` (series, beta by lag).  Every evaluation is one job; the search state,
    one row per series, is written after each."""
    shape = Shape(order)

    def first(batches):
        for pdf in batches:
            yield pd.DataFrame({"series": pdf["series"], "theta": [shape.from_lags(b).tolist() for b in pdf["beta"]]})
    # a series without enough rows for the first stage starts at zero
    zero = F.array(*[F.lit(0.0)] * (len(shape.ar_lags) + len(shape.ma_lags))).cast("array<double>")
    named = join_on(blocks.select("series").distinct(), start, "series", "left").select(
        "series", F.coalesce("beta", zero).alias("beta"))
    search = named.mapInPandas(first, "series string, theta array<double>").select(
        "series", "theta", F.lit(None).cast("array<double>").alias("best"), F.lit(None).cast("double").alias("sse"),
        F.lit(None).cast("array<double>").alias("cells"), F.lit(1e-3).alias("damping"), F.lit(0).cast("long").alias("n"),
        F.lit(False).alias("done"))
    search = materialize(search)
    for _ in range(1 + (steps if shape.params else 0)):
        found = _sums(blocks, search.select("series", "theta"), shape, block).select(
            "series", F.col("cells").alias("found"), F.col("n").alias("found_n"))
        search = materialize(join_on(search, found, "series").mapInPandas(_move(shape), _SEARCH))
        if search.where("NOT done").isEmpty():
            break
    best = materialize(search.select("series", F.col("best").alias("theta"), "sse", "n"))

    def describe(batches):
        for pdf in batches:
            by_lag = [shape.by_lag(np.array(t, float)) for t in pdf["theta"]]
            yield pd.DataFrame({"series": pdf["series"], "ar": [x[0] for x in by_lag], "ma": [x[1] for x in by_lag],
                                "sigma2": pdf["sse"] / np.maximum(pdf["n"], 1), "n": pdf["n"]})
    model = materialize(best.mapInPandas(describe, "series string, ar array<double>, ma array<double>, sigma2 double, "
                                                   "n long"))
    return model, _with_residuals(blocks, best.select("series", "theta"), shape, block)


def _with_residuals(blocks: DataFrame, theta: DataFrame, shape: Shape, block: int) -> DataFrame:
    def run(batches):
        for pdf in batches:
            if len(pdf):
                w, ok, size = _unpacked(pdf)
                p = np.stack(pdf["theta"]).reshape(len(pdf), -1)
                z, _ = run_blocks(shape, p, w, np.stack(pdf["state"]).reshape(len(pdf), -1))
                e = residuals(shape, p, z, w.shape[1]) * ok
                yield pd.DataFrame({"series": pdf["series"], "block": pdf["block"],
                                    "e": [x[:n] for x, n in zip(e, size, strict=True)]})
    states = _start_states(blocks, theta, shape, block)
    e = join_on(join_on(_slim(blocks), states, ["series", "block"]), theta, "series").mapInPandas(
        run, "series string, block long, e array<double>")
    rows = join_on(blocks, e, ["series", "block"]).select("series", F.explode(F.arrays_zip("rows", "e")).alias("x"))
    return rows.select("series", "x.rows.bar_ts", F.col("x.rows.pos").alias(POS), "x.rows.y", "x.rows.w", "x.e")
