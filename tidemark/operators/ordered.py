"""Row-ordered frames for many series without one task per series.

Every rolling / lag / recursive indicator is a function of a row position
inside its series.  Partitioning a window only by ``series`` would send a
whole series — possibly a third of all rows — to one task.  Instead:

1. ``with_position`` numbers the rows of each series.  Rows are first grouped
   by (series, time block); bars are unique per (series, bar_ts) and have a
   fixed grain, so a time block of ``block_seconds`` holds a bounded number of
   rows.  Block sizes are prefix-summed on the tiny block table and joined
   back (AQE broadcasts it when small, shuffle-joins it otherwise).
2. ``with_halo`` cuts positions into chunks of ``chunk_rows`` and copies the
   last ``halo`` rows of every chunk into the next one (``explode`` of a
   one- or two-element array, no second scan).
3. Window functions then run over ``partitionBy(series, chunk).orderBy(pos)``;
   every frame that reaches back at most ``halo`` rows sees exactly the rows
   a whole-series window would see.  ``strip`` drops the halo copies.

Quantities that accumulate over the whole series (forward fill, products,
cumulative sums) use ``chunk_carry``: one summary row per chunk, a prefix over
the chunk table, and a join on (series, chunk).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import join_on

POS = "_pos"
CHUNK = "_chunk"
HALO = "_halo"
_TB = "_tb"
_RN = "_rn"
_CNT = "_cnt"
_OFF = "_off"
_NTH = "_nth"


@dataclass(frozen=True)
class Layout:
    """How a bar table is ordered and split.

    series: partition key column; ts: order key (unique per series).
    block_seconds: time span used to number rows (bounds rows per task when
    bars have a fixed grain: at most block_seconds / grain rows).
    chunk_rows: rows per window task, before the halo.
    """

    series: str = "series"
    ts: str = "bar_ts"
    block_seconds: int = 4096 * 3600
    chunk_rows: int = 1 << 15

    def window(self):
        return Window.partitionBy(self.series, CHUNK).orderBy(POS, F.col(self.ts).asc_nulls_last())

    def window_sql(self) -> str:
        """The same window as SQL text (for expressions built as strings)."""
        return f"PARTITION BY `{self.series}`, `{CHUNK}` ORDER BY `{POS}`, `{self.ts}` NULLS LAST"


HOURLY = Layout(block_seconds=4096 * 3600)
MINUTE = Layout(block_seconds=4096 * 60)
DAILY = Layout(block_seconds=4096 * 86400)


def _block_id(layout: Layout) -> Column:
    ts = F.col(layout.ts).cast("timestamp")
    return F.floor(F.unix_micros(ts) / F.lit(layout.block_seconds * 1_000_000))


def with_position(df: DataFrame, layout: Layout = HOURLY, count: str | None = None) -> DataFrame:
    """Add ``_pos`` (0-based row number inside the series, ordered by ts).

    Rows without a time stamp come last in their series; a null series is a
    series.  With ``count`` only rows with a value there are numbered: others
    share the position of the last one before (-1 if there is none)."""
    if POS in df.columns:
        if count is None:
            return df
        df = df.drop(POS)
    s = layout.series
    block = _block_id(layout)
    inside = Window.partitionBy(s, block)
    order = inside.orderBy(F.col(layout.ts).asc_nulls_last())
    numbered = df.select("*", block.alias(_TB), F.row_number().over(order).alias(_RN),
                         F.count(count or F.lit(1)).over(inside).alias(_CNT))
    if count:
        numbered = numbered.withColumn(_NTH, F.count(count).over(
            order.rowsBetween(Window.unboundedPreceding, 0)))
    before = (Window.partitionBy(s).orderBy(F.col(_TB).asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    blocks = numbered.filter(F.col(_RN) == 1).select(
        s, _TB, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    nth = F.col(_NTH if count else _RN)
    return join_on(numbered, blocks, [s, _TB]).select(
        *df.columns, (F.col(_OFF) + nth - 1).cast("long").alias(POS))


def with_halo(df: DataFrame, halo: int, layout: Layout = HOURLY, count: str | None = None) -> DataFrame:
    """Add ``_chunk`` and copy the last ``halo`` positions of each chunk forward.

    ``posexplode`` of [own chunk] or [own chunk, next chunk]: element 1 is
    the halo copy, flagged by ``_halo`` (a cheap projection of the index).  A
    halo longer than half a chunk makes the chunks longer."""
    c = max(layout.chunk_rows, 2 * halo)
    df = with_position(df, layout, count)
    own = F.expr(f"greatest({POS}, 0) div {c}")
    in_tail = (F.col(POS) >= 0) & (F.pmod(F.col(POS), F.lit(c)) >= F.lit(c - halo))
    targets = F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))
    return df.select("*", F.posexplode(targets).alias(HALO, CHUNK))


def strip(df: DataFrame, keep_pos: bool = False) -> DataFrame:
    """Drop halo copies and helper columns."""
    out = df.filter(F.col(HALO) == 0) if HALO in df.columns else df
    keep = [c for c in out.columns if not c.startswith("_") or (keep_pos and c == POS)]
    return out.select(*keep)


def run_windows(df: DataFrame, build, halo: int, layout: Layout = HOURLY,
                keep_pos: bool = False, count: str | None = None) -> DataFrame:
    """Position + halo, ``build(frame, w)`` adds columns, then strip.  A frame
    that comes numbered stays so, and is not numbered again."""
    framed = with_halo(df, halo, layout, count)
    keep_pos = keep_pos or (POS in df.columns and count is None)
    return strip(build(framed, layout.window()), keep_pos=keep_pos)


def series_counts(df: DataFrame, layout: Layout = HOURLY, name: str = "n_rows") -> DataFrame:
    """Rows per series (partial aggregation, no hot task)."""
    return df.groupBy(layout.series).agg(F.count(F.lit(1)).alias(name))


def chunk_carry(framed: DataFrame, layout: Layout, aggs: dict[str, Column],
                prefix: dict[str, callable]) -> DataFrame:
    """Per-chunk summaries folded over earlier chunks.

    ``aggs`` are aggregate expressions over the non-halo rows of a chunk;
    ``prefix[name](col_name, w)`` turns them into a value carried into the
    chunk from all earlier chunks (``w`` orders chunks of one series, frame up
    to the previous chunk).  Returns (series, _chunk, carry columns...).
    """
    s = layout.series
    summary = framed.filter(F.col(HALO) == 0).groupBy(s, CHUNK).agg(
        *[e.alias(k) for k, e in aggs.items()])
    w = Window.partitionBy(s).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(s, CHUNK, *[fn(k, w).alias(f"_carry_{k}") for k, fn in prefix.items()])
