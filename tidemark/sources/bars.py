"""OHLCV bars from raw ticks (S3).

``build_bars`` is a single ``groupBy(series, bucket)``: partial aggregation
runs map-side, so only one row per (series, bucket) per input partition is
shuffled, and the shuffle key has one value per bar — no hot key even when a
single series carries most ticks.  Open/close are ``min_by``/``max_by`` on a
struct order key so ties are broken deterministically.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import SERIES, TS

BAR_COLUMNS = [SERIES, TS, "open", "high", "low", "close", "volume"]


def bucket(ts: Column | str, grain: str) -> Column:
    """Bar start of a timestamp as a time-zone-free timestamp.

    Minute / hour / day bars are rebuilt from the wall-clock fields, so the
    session time zone (and its DST gaps) cannot shift a bar."""
    t = F.col(ts) if isinstance(ts, str) else ts
    zero = F.lit(0)
    fields = {
        "minute": (F.hour(t), F.minute(t)),
        "hour": (F.hour(t), zero),
        "day": (zero, zero),
    }
    if grain in fields:
        h, m = fields[grain]
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), h, m, zero)
    return F.date_trunc(grain, t).cast("timestamp_ntz")


def build_bars(df: DataFrame, ts: str, price: Column | str, series: Column | str,
               grain: str = "hour", order: Sequence[str] | None = None,
               volume: Column | str | None = None) -> DataFrame:
    """Aggregate ticks into bars.

    price/series/volume may be column names or expressions; ``volume=None``
    counts ticks; ``order`` is the tie-breaking order key (default: ts).
    """
    p = F.col(price) if isinstance(price, str) else price
    s = F.col(series) if isinstance(series, str) else series
    key = F.struct(*[F.col(c) for c in (order or [ts])])
    vol = F.count(F.lit(1)) if volume is None else F.sum(
        F.col(volume) if isinstance(volume, str) else volume)
    return (
        df.groupBy(s.alias(SERIES), bucket(ts, grain).alias(TS))
        .agg(
            F.min_by(p, key).alias("open"),
            F.max(p).alias("high"),
            F.min(p).alias("low"),
            F.max_by(p, key).alias("close"),
            vol.alias("volume"),
        )
    )


def bar_states(df: DataFrame, ts: str, price: Column | str, series: Column | str, grain: str = "minute",
               order: Sequence[str] | None = None, volume: Column | str | None = None) -> DataFrame:
    """Bars that roll up: as ``build_bars``, with the order keys of the open and
    the close (``open_key``, ``close_key``)."""
    p = F.col(price) if isinstance(price, str) else price
    s = F.col(series) if isinstance(series, str) else series
    key = F.struct(*[F.col(c) for c in (order or [ts])])
    vol = F.count(F.lit(1)) if volume is None else F.sum(F.col(volume) if isinstance(volume, str) else volume)
    # the price with its key, so that rows without a price lend no key to the open or the close
    first, last = (f(F.when(p.isNotNull(), F.struct(key.alias("k"), p.alias("p")))) for f in (F.min, F.max))
    return df.groupBy(s.alias(SERIES), bucket(ts, grain).alias(TS)).agg(
        first.alias("_o"), F.max(p).alias("high"), F.min(p).alias("low"), last.alias("_c"), vol.alias("volume")).select(
        SERIES, TS, F.col("_o.p").alias("open"), "high", "low", F.col("_c.p").alias("close"), "volume",
        F.col("_o.k").alias("open_key"), F.col("_c.k").alias("close_key"))


def roll_up(states: DataFrame, grain: str) -> DataFrame:
    """Bars of a coarser grain (hours or days) out of finer ones; they roll up
    further.  A state without a price adds its volume only."""
    return states.groupBy(SERIES, bucket(TS, grain).alias(TS)).agg(
        F.min_by("open", "open_key").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "close_key").alias("close"), F.sum("volume").alias("volume"),
        F.min("open_key").alias("open_key"), F.max("close_key").alias("close_key"))


def events_bars(events: DataFrame, grain: str = "hour") -> DataFrame:
    """Main fixture: one series per event type, price = value, volume = ticks."""
    return build_bars(events, "ts", "value", "event_type", grain, ["ts", "event_id"])


def orders_bars(orders: DataFrame) -> DataFrame:
    """Daily bars of order totals per priority."""
    return build_bars(orders, "o_orderdate", "o_totalprice", "o_orderpriority", "day",
                      ["o_orderkey"])


def lineitem_bars(lineitem: DataFrame) -> DataFrame:
    """Daily bars of unit price per return flag, volume = quantity."""
    unit = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return build_bars(
        lineitem, "l_shipdate", unit, "l_returnflag", "day",
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
        volume="l_quantity")
