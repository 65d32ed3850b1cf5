"""State of the bar streams: known bars per series as a compacted table, and a
reorder buffer in Spark's state store.

``BarState`` holds the last bars of every series below a folder: a batch writes
those of the series that it changed (``delta=<n>``), and every few batches all
deltas are merged into a generation (``gen=<n>``: the state before batch n).  Two
generations are kept, so that the last batches can run again.  Folders are found
by listing; nothing reads what it doesn't need.

``settle`` puts a stream's bars in the order of time: a processor for each (series,
stretch of time) holds bars in list state until the watermark has passed them, and
event-time timers hand them on in order.  A series, however long, is spread over as
many keys as it has stretches.  What comes too late goes on marked ``late``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType, TimestampNTZType

from tidemark.functions.exprs import join_on
from tidemark.operators import ordered
from tidemark.operators.ordered import HOURLY, Layout

#: Batches whose deltas make a generation.
EVERY = 16


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, wherever Spark reads it from."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def numbered(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the completely written folders ``root``/name=<n>, ascending."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    found = [x.getPath().getName() for x in fs.listStatus(p)]
    return sorted(int(x.split("=")[1]) for x in found
                  if x.startswith(f"{name}=") and exists(spark, f"{root}/{x}/_SUCCESS"))


class BarState:
    """The last ``keep`` bars of each series (with ``count``: back to the
    ``keep``-th last one that has a value there), and ``cut``: the first bar that
    can still be revised, as ``lookback`` bars are known before it; null while
    the whole series is held."""

    def __init__(self, root: str, schema: StructType, keep: int, lookback: int = 0, count: str | None = None,
                 every: int = EVERY, layout: Layout = HOURLY):
        self.root, self.keep, self.lookback, self.count, self.every = root, keep, lookback, count, every
        self.layout = layout
        self.schema = StructType([*schema.fields]).add("cut", TimestampNTZType())

    def before(self, spark: SparkSession, n: int, of: DataFrame | None = None) -> DataFrame:
        """The state before batch ``n``, of the series in ``of``."""
        gens = [g for g in numbered(spark, self.root, "gen") if g <= n]
        first = gens[-1] if gens else 0
        paths = [f"{self.root}/gen={first}"] if gens else []
        paths += [f"{self.root}/delta={d}" for d in numbered(spark, self.root, "delta") if first <= d < n]
        if not paths:
            return spark.createDataFrame([], self.schema)
        # a generation counts as older than the delta of the same number
        parts = [spark.read.schema(self.schema).parquet(p).withColumn("_n", F.lit(i)) for i, p in enumerate(paths)]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if of is not None:
            rows = join_on(rows, of.select("series").distinct(), "series", "left_semi")
        if len(parts) == 1:
            return rows.drop("_n")
        last = rows.groupBy("series").agg(F.max("_n").alias("_last"))
        return join_on(rows, last, "series").where("_n = _last").drop("_n", "_last")

    def write(self, n: int, rows: DataFrame, known: DataFrame) -> None:
        """State after batch ``n`` of the series in ``rows`` (all their bars known
        now; ``known``: their state before)."""
        spark, cols = rows.sparkSession, [f.name for f in self.schema.fields if f.name != "cut"]
        placed = ordered.with_position(rows.select(*cols), self.layout, count=self.count)
        size = placed.groupBy("series").agg((F.max(ordered.POS) + 1).alias("_size"))
        held = join_on(placed, size, "series").where(F.col(ordered.POS) >= F.col("_size") - self.keep)
        edge = held.where((F.col("_size") > self.keep) & (
            F.col(ordered.POS) == F.col("_size") - self.keep + self.lookback)).groupBy("series").agg(
            F.min(self.layout.ts).alias("_new"))
        cut = edge.unionByName(known.groupBy("series").agg(F.max("cut").alias("_new"))).groupBy("series").agg(
            F.max("_new").alias("cut"))
        join_on(held.select(*cols), cut, "series", "left").write.mode("overwrite").parquet(f"{self.root}/delta={n}")
        gens = numbered(spark, self.root, "gen")
        if n + 1 - (gens[-1] if gens else 0) >= self.every:
            self.compact(spark, n + 1)

    def compact(self, spark: SparkSession, n: int) -> None:
        """Write the generation before batch ``n``; keep the last two and what
        batches since the older one have written."""
        self.before(spark, n).write.mode("overwrite").parquet(f"{self.root}/gen={n}")
        gens = numbered(spark, self.root, "gen")
        oldest = gens[-2] if len(gens) > 1 else 0
        for kind in ("gen", "delta"):
            for old in numbered(spark, self.root, kind):
                if old < oldest:
                    remove(spark, f"{self.root}/{kind}={old}")


# ------------------------------------------------------------------ order

#: Added to event time, as Spark's watermark starts in 1970 and bars may be older.
SHIFT = 36_000_000_000_000_000
_MS = 1000
SETTLED = "series string, kind string, us long, close double"


def _rows(series: str | None, kind: str, bars: pd.DataFrame) -> Iterator[pd.DataFrame]:
    if len(bars):
        yield pd.DataFrame({"series": pd.Series([series] * len(bars), dtype=object), "kind": kind,
                            "us": bars["us"].astype("int64").to_numpy(), "close": bars["close"].astype(float).to_numpy()})


class _Reorder(StatefulProcessor):
    """Holds one stretch of a series: segments of (times, closes), one for each
    batch that brought some."""

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "seq long, us array<long>, close array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * _MS
        pdf = pd.concat(list(rows))  # of one stretch: bounded
        new = pdf[pdf["us"] > passed]
        if len(new):
            self.pending.appendValue((timerValues.getCurrentProcessingTimeInMs(), new["us"].tolist(),
                                      new["close"].tolist()))
            self.handle.registerTimer(-(-int(new["us"].min()) // _MS))
        old = pdf[pdf["us"] <= passed]
        yield from _rows(key[0], "late", old)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * _MS
        parts = [pd.DataFrame({"seq": s, "us": u, "close": c}) for s, u, c in self.pending.get()]
        held = pd.concat(parts) if parts else pd.DataFrame({"seq": [], "us": [], "close": []})
        held = held.sort_values(["us", "seq", "close"], na_position="first").drop_duplicates("us", keep="last")
        rest, done = held[held["us"] > passed], held[held["us"] <= passed]
        if not len(rest):
            self.pending.clear()
        elif len(done):
            self.pending.put([(int(s), g["us"].astype("int64").tolist(), g["close"].tolist())
                              for s, g in rest.groupby("seq")])
            self.handle.registerTimer(-(-int(rest["us"].min()) // _MS))
        yield from _rows(key[0], "bar", done)

    def close(self) -> None:
        pass


def settle(bars_stream: DataFrame, delay: str, layout: Layout = HOURLY) -> DataFrame:
    """``series, kind, us, close``: bars (``bar``) once the watermark, ``delay``
    behind the newest bar, has passed them, each after all earlier ones; of those
    with the same time the one delivered last.  Bars at or behind the watermark
    when they arrive, and those without a time, come out as ``late`` at once.
    ``us`` is the time in shifted microseconds (see ``when``)."""
    us = F.coalesce(F.unix_micros(F.col(layout.ts).cast("timestamp")) + F.lit(SHIFT), F.lit(-1))
    rows = bars_stream.select("series", us.alias("us"), F.col("close").cast("double").alias("close"))
    # without its time column the operator gets late rows too, instead of Spark dropping them
    rows = rows.withColumn("_t", F.timestamp_micros("us")).withWatermark("_t", delay).select(
        "series", F.floor(F.col("us") / F.lit(layout.block_seconds * 1_000_000)).alias("stretch"), "us", "close")
    return rows.groupBy("series", "stretch").transformWithStateInPandas(_Reorder(), SETTLED, "append", "eventTime")


def when(rows: DataFrame) -> DataFrame:
    """``series, bar_ts, close`` of settled rows; NaN is null."""
    return rows.select("series", F.when(F.col("us") >= 0, F.timestamp_micros(F.col("us") - F.lit(SHIFT)).cast(
        "timestamp_ntz")).alias("bar_ts"), F.when(~F.isnan("close"), F.col("close")).alias("close"))


def waiting(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The bars that ``settle`` still holds, read from its state store."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "pending").load()
    rows = held.select(F.col("key.series").alias("series"), F.col("list_element.seq").alias("seq"),
                       F.explode(F.arrays_zip(F.col("list_element.us").alias("us"),
                                              F.col("list_element.close").alias("close"))).alias("b"))
    best = rows.groupBy("series", F.col("b.us").alias("us")).agg(
        F.max_by("b.close", F.struct("seq", "b.close")).alias("close"))
    return when(best)
