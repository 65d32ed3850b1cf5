"""Small Column builders shared by the operators.

All arithmetic stays in built-in Spark expressions; division goes through
``try_divide`` so a zero denominator gives null (ANSI mode raises otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str] | str,
            how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null, so that rows with a null key
    meet their group's row.  Key columns come from ``left``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        return left.crossJoin(right)  # one row of whole-table statistics
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(right, on, how).drop(*[f"__{k}" for k in keys])


def div(n: Column | str, d: Column | str) -> Column:
    """n / d, null when d is 0 or null."""
    return F.try_divide(col(n), col(d))


def frame(w: WindowSpec, n: int) -> WindowSpec:
    """The last n rows up to and including the current one."""
    return w.rowsBetween(-(n - 1), 0)


def full(value: Column, x: Column | str, w: WindowSpec, n: int) -> Column:
    """``value`` only where the n-row frame holds n non-null x (min_periods=n)."""
    return F.when(F.count(col(x)).over(frame(w, n)) == n, value)


def sma_full(x: Column | str, w: WindowSpec, n: int) -> Column:
    return full(F.avg(col(x)).over(frame(w, n)), x, w, n)


def sma_partial(x: Column | str, w: WindowSpec, n: int) -> Column:
    return F.avg(col(x)).over(frame(w, n))


def std_full(x: Column | str, w: WindowSpec, n: int) -> Column:
    return full(F.stddev_samp(col(x)).over(frame(w, n)), x, w, n)


def safe_log(x: Column | str) -> Column:
    """Natural log, null for x <= 0."""
    return F.when(col(x) > 0, F.log(col(x)))


def direction(x: Column | str) -> Column:
    """-1 / 0 / 1 as an int (sign of x), null stays null."""
    return F.signum(col(x)).cast("int")


def clean_double(x: Column | str, digits: int = 6) -> Column:
    """Round for cross-engine comparison: scale up, round to an integer, scale
    down (integer rounding of a double agrees across engines, decimal-place
    rounding does not); ``+ 0.0`` folds -0.0 into 0.0."""
    k = float(10 ** digits)
    return F.round(col(x) * F.lit(k), 0) / F.lit(k) + F.lit(0.0)
