"""Structured Streaming jobs.

The polling loop of the scoring script becomes a file stream with a trigger:
``processingTime="60 seconds"`` in production, ``availableNow`` for a bounded
replay.  Every job lives below a ``root`` folder that the caller names (in the
shared folder): checkpoint, tail state and result.  Starting a job again on the
same root resumes where it stopped.

Window functions over rows (lag, row frames) are not allowed on streams;
indicators are computed per micro-batch over the last known bars of its series plus
the batch.  T3 and T7 take bars as they come and revise; T4 first puts them in the
order of time in Spark's state store (``state.settle``) and writes each row once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from tidemark.functions.exprs import join_on
from tidemark.operators import ema, ordered
from tidemark.operators.indicators import EMA_SPANS, RSI_PERIOD, SMA_PERIODS, rsi_partial_expr, sma_cols
from tidemark.operators.ordered import HOURLY, Layout
from tidemark.sources.files import BAR_SCHEMA
from tidemark.streaming import state

TICK_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType())])

WATERMARK = "10 minutes"


# ------------------------------------------------------------------ plumbing

def stream_source(spark: SparkSession, path: str, schema: StructType = TICK_SCHEMA,
                  max_files: int | None = None) -> DataFrame:
    """A parquet file stream with a declared schema."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def run(df: DataFrame, root: str, mode: str = "append", trigger: dict | None = None,
        foreach_batch=None, drain: bool = False):
    """Start a query whose checkpoint is ``root``/checkpoint and whose output is
    ``root``/out (unless ``foreach_batch`` writes it), wait until it ends
    (``availableNow``, the default, ends with the available input) and return
    (query, output path).  ``drain`` stops a query with an endless trigger once
    it has no more input."""
    out = f"{root}/out"
    w = df.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint")
    w = w.trigger(**(trigger or {"availableNow": True}))
    w = w.foreachBatch(foreach_batch) if foreach_batch else w.format("parquet").option("path", out)
    q = w.start()
    if drain:
        q.processAllAvailable()
        q.stop()
    q.awaitTermination()
    return q, out


def count_input(df: DataFrame, root: str, trigger: dict | None = None, drain: bool = False) -> DataFrame:
    """Rows read by each micro-batch (``batch_id, num_input_rows``), written
    as they are processed, so that a stream of any length is counted; a batch
    that is run again replaces its own count."""
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.lit(batch_id).cast("long").alias("batch_id"), F.count("*").alias("num_input_rows")).write.mode(
            "overwrite").parquet(f"{root}/counts/n={batch_id}")
    run(df, root, trigger=trigger, foreach_batch=step, drain=drain)
    return df.sparkSession.read.parquet(f"{root}/counts").select("batch_id", "num_input_rows")


# ------------------------------------------------------------------ T1, T2

def _bars(keyed) -> DataFrame:
    key = F.struct("ts", "event_id")
    return keyed.agg(F.min_by("value", key).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
                     F.max_by("value", key).alias("close"), F.count(F.lit(1)).alias("volume"))


def ohlc_tumbling(ticks: DataFrame, grain: str = "1 hour", watermark: str = WATERMARK,
                  once: bool = False) -> DataFrame:
    """Ticks -> tumbling OHLCV bars; a bar is emitted once the watermark
    passes its end (late ticks beyond the watermark are dropped).  With ``once``
    a tick delivered again within the watermark counts once."""
    t = ticks.withColumn("_t", F.col("ts").cast("timestamp")).withWatermark("_t", watermark)
    if once:
        t = t.dropDuplicatesWithinWatermark(["event_id"])
    bars = _bars(t.groupBy(F.window("_t", grain).alias("w"), F.col("event_type").alias("series")))
    return bars.select("series", F.col("w.start").cast("timestamp_ntz").alias("bar_ts"),
                       "open", "high", "low", "close", "volume")


def dedup(ticks: DataFrame, key: str = "event_id", watermark: str = WATERMARK) -> DataFrame:
    """A record delivered again within the watermark is kept once."""
    t = ticks.withColumn("_t", F.col("ts").cast("timestamp")).withWatermark("_t", watermark)
    return t.dropDuplicatesWithinWatermark([key]).drop("_t")


def open_bars(ticks: DataFrame, bars: DataFrame, grain: str = "1 hour", once: bool = False) -> DataFrame:
    """Bars that a bounded replay leaves open, computed from its (batch) ticks:
    those of the windows behind the last one that the stream has emitted into
    ``bars`` (a window is emitted once the watermark has passed its end, so all
    earlier ones are closed).  Only ticks from there on are read."""
    last = bars.agg(F.max("bar_ts").alias("t")).first()["t"]
    if last is not None:
        since = F.lit(last).cast("timestamp_ntz") + F.expr(f"INTERVAL {grain}")
        ticks = ticks.where(F.col("ts") >= since)
    if once:
        ticks = ticks.dropDuplicates(["event_id"])
    start = F.window(F.col("ts").cast("timestamp"), grain)["start"].cast("timestamp_ntz")
    return _bars(ticks.groupBy(F.col("event_type").alias("series"), start.alias("bar_ts")))


def bars_job(spark: SparkSession, ticks_path: str, root: str, bounded: bool = True,
             trigger: dict | None = None, once: bool = False) -> str:
    """T1 as a job: closed bars of the ticks below ``ticks_path`` are written to
    ``root``/bars/<batch>.  A ``bounded`` replay also writes those left open at its
    end to ``root``/open, in place of an earlier run's: a later run emits them from
    the stream, with the ticks that came since.  Returns the path pattern of all
    bars (without ``bounded``: of the closed ones)."""
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/bars/{batch_id}")
    run(ohlc_tumbling(stream_source(spark, ticks_path), once=once), root, trigger=trigger, foreach_batch=step)
    closed = f"{root}/bars/*"
    if not bounded:
        return closed
    done = spark.read.schema(BAR_SCHEMA).parquet(closed) if state.exists(spark, f"{root}/bars") else \
        spark.createDataFrame([], BAR_SCHEMA)
    open_bars(spark.read.schema(TICK_SCHEMA).parquet(ticks_path), done, once=once).write.mode(
        "overwrite").parquet(f"{root}/open")
    return f"{root}/{{bars/*,open}}"


# ------------------------------------------------------------------ T3, T7

#: Longest row frame of the real-time indicators (a delta needs one row more).
LOOKBACK = max(*SMA_PERIODS, *EMA_SPANS, RSI_PERIOD + 1)
#: Bars of a series, counted from its last one, that can still be revised.
REVISED = 100


class PerBatch:
    """Incremental recomputation per micro-batch over the bars known of the series
    in it (``state.BarState``: the last LOOKBACK + REVISED bars).

    A bar delivered again replaces the known one (of several in one batch the
    largest row); rows of a series from its first new bar on are written to
    ``result/n=<n>``.  Running a batch again reads the same state and overwrites its
    own folders, so a retry changes nothing.  Readers take a bar's row from the last
    batch that has it.  A bar before its series' cut (LOOKBACK bars must be known
    before it, or the whole series), and one without a time, goes to ``late/n=<n>``."""

    def __init__(self, root: str, compute: Callable[[DataFrame], DataFrame], changed_only: bool = True,
                 key: tuple[str, ...] = ("series", "bar_ts")):
        self.root, self.compute, self.changed_only, self.key = root, compute, changed_only, key
        self.state = state.BarState(f"{root}/state", BAR_SCHEMA, LOOKBACK + REVISED, LOOKBACK)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, cols, key = batch.sparkSession, BAR_SCHEMA.names, ["series", "bar_ts"]
        rest = [c for c in cols if c not in key]
        fresh = batch.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_r")).select(*key, "_r.*")
        known = self.state.before(spark, batch_id, of=batch).persist()
        cut = known.groupBy("series").agg(F.max("cut").alias("_cut"))
        fresh = join_on(fresh, cut, "series", "left").withColumn(
            "_late", F.col("bar_ts").isNull() | F.coalesce(F.col("bar_ts") < F.col("_cut"), F.lit(False))).persist()
        fresh.where("_late").select(*cols).write.mode("overwrite").parquet(f"{self.root}/late/n={batch_id}")
        fresh_in = fresh.where("NOT _late").select(*cols)
        old = join_on(known.select(*cols), fresh_in.select(*key), key, "left_anti")
        both = join_on(old.unionByName(fresh_in), fresh_in.select("series").distinct(), "series", "left_semi").persist()
        out = self.compute(both)
        if self.changed_only:
            first = fresh_in.groupBy("series").agg(F.min("bar_ts").alias("_from"))
            out = join_on(out, first, "series").where(F.col("bar_ts") >= F.col("_from")).drop("_from")
        out.write.mode("overwrite").parquet(f"{self.root}/result/n={batch_id}")
        self.state.write(batch_id, both, known)
        for df in (both, fresh, known):
            df.unpersist()

    def result(self, spark: SparkSession) -> DataFrame:
        """The rows written so far, of each key the last."""
        rows = spark.read.parquet(f"{self.root}/result")
        cols = [c for c in rows.columns if c not in (*self.key, "n")]
        return rows.groupBy(*self.key).agg(F.max_by(F.struct(*cols), "n").alias("r")).select(*self.key, "r.*")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/late").drop("n")

    def compact(self, spark: SparkSession) -> None:
        """Merge the result folders into that of their last batch (between runs;
        the checkpoint keeps that batch from running again)."""
        done = state.numbered(spark, f"{self.root}/result", "n")
        if len(done) > 1:
            merged = f"{self.root}/merged"
            self.result(spark).write.mode("overwrite").parquet(merged)
            spark.read.parquet(merged).write.mode("overwrite").parquet(f"{self.root}/result/n={done[-1]}")
            for n in done[:-1]:
                state.remove(spark, f"{self.root}/result/n={n}")
            state.remove(spark, merged)


def indicators_per_batch(bars_stream: DataFrame, root: str, trigger=None) -> PerBatch:
    """Real-time indicators of every bar, revised when bars come again."""
    from tidemark.operators.indicators import realtime_features
    job = PerBatch(root, realtime_features)
    run(bars_stream, root, foreach_batch=job, trigger=trigger)
    return job


def kpis_per_batch(bars_stream: DataFrame, root: str, score: Callable[[DataFrame], DataFrame],
                   trigger=None, kpi: Callable[[DataFrame], DataFrame] | None = None) -> PerBatch:
    """One row per series, kept current; a batch writes those of its own series.
    By default K1 (latest price, change, prediction, its difference and RSI);
    ``kpi=latest_prediction`` keeps K3 (latest actual, predicted, error)."""
    from tidemark.operators.kpis import latest_kpis
    job = PerBatch(root, lambda bars: (kpi or latest_kpis)(score(bars)), changed_only=False, key=("series",))
    run(bars_stream, root, foreach_batch=job, trigger=trigger)
    return job


# ------------------------------------------------------------------ T5 with K3

def match_predictions(predictions: DataFrame, prices: DataFrame, within: str, delay: str = WATERMARK) -> DataFrame:
    """Streams of ``series, made_ts, target_ts, predicted_price`` and of bars: each
    prediction with the bars of its series from ``target_ts`` to ``within`` later
    and the error in percent.  One that has met no bar comes out without, once the
    watermark (``delay`` behind the older of both streams) has passed its time.
    Both sides wait in state for no longer than that."""
    made = predictions.withColumn("_target", F.col("target_ts").cast("timestamp")).withWatermark("_target", delay)
    seen = prices.select(F.col("series").alias("_s"), "bar_ts", F.col("close").alias("actual_price")).withColumn(
        "_bar", F.col("bar_ts").cast("timestamp")).withWatermark("_bar", delay)
    on = (F.col("series") == F.col("_s")) & (F.col("_bar") >= F.col("_target")) & (
        F.col("_bar") <= F.col("_target") + F.expr(f"INTERVAL {within}"))
    error = F.abs(F.col("predicted_price") - F.col("actual_price"))
    return made.join(seen, on, "left").select(
        "series", "made_ts", "target_ts", "predicted_price", "bar_ts", "actual_price",
        (F.try_divide(error, F.col("actual_price")) * 100).alias("prediction_error_pct"))


# ------------------------------------------------------------------ T4

STATE_OUT = StructType([
    StructField("series", StringType()), StructField("bar_ts", TimestampNTZType()),
    StructField("close", DoubleType()), StructField("sma_5", DoubleType()),
    StructField("sma_20", DoubleType()), StructField("ema_5", DoubleType()),
    StructField("ema_20", DoubleType()), StructField("rsi", DoubleType())])
_CLOSES = StructType([f for f in STATE_OUT.fields if f.name in ("series", "bar_ts", "close")])
#: Observations before a bar that its recursive EMA can see (to 1e-17).
MEMORY = max(LOOKBACK, *(ema.horizon(n) for n in EMA_SPANS))


def state_features(closes: DataFrame, layout: Layout = HOURLY) -> DataFrame:
    """SMA 5/20 and RSI 14 (partial frames) and the recursive EMA 5/20 of
    ``series, bar_ts, close`` by chunked windows: no task holds a series."""
    def build(f, w):
        f = ema.ema_columns(f, [("close", n, f"ema_{n}") for n in EMA_SPANS], layout)
        return f.withColumns({**sma_cols(w, partial=True), "rsi": rsi_partial_expr(w)})
    out = ordered.run_windows(closes.select(*_CLOSES.names), build, MEMORY, layout, count="close")
    return out.select(*STATE_OUT.names)


class Settled:
    """T4: indicators of every bar, once, in the order of time.

    ``state.settle`` hands bars on when the watermark has passed them; a batch of
    any size is computed by chunked windows over the last MEMORY observations of
    its series and itself, and adds to ``result/n=<n>``.  Late bars are in
    ``late/n=<n>``."""

    def __init__(self, root: str, layout: Layout = HOURLY):
        self.root, self.layout = root, layout
        self.state = state.BarState(f"{root}/state", _CLOSES, MEMORY, count="close", layout=layout)

    def _rows(self, new: DataFrame, known: DataFrame) -> DataFrame:
        both = known.select(*_CLOSES.names).unionByName(new)
        first = new.groupBy("series").agg(F.min("bar_ts").alias("_from"))
        return join_on(state_features(both, self.layout), first, "series").where(
            F.col("bar_ts") >= F.col("_from")).drop("_from")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, batch = batch.sparkSession, batch.persist()
        state.when(batch.where("kind = 'late'")).write.mode("overwrite").parquet(f"{self.root}/late/n={batch_id}")
        new = state.when(batch.where("kind = 'bar'")).persist()
        known = self.state.before(spark, batch_id, of=new).persist()
        self._rows(new, known).write.mode("overwrite").parquet(f"{self.root}/result/n={batch_id}")
        self.state.write(batch_id, known.select(*_CLOSES.names).unionByName(new), known)
        for df in (known, new, batch):
            df.unpersist()

    def result(self, spark: SparkSession) -> DataFrame:
        """Rows of the settled bars."""
        return spark.read.schema(STATE_OUT).parquet(f"{self.root}/result/*")

    def open(self, spark: SparkSession) -> DataFrame:
        """Rows that the bars still waiting for the watermark would have now."""
        done = state.numbered(spark, f"{self.root}/result", "n")
        new = state.waiting(spark, f"{self.root}/checkpoint")
        return self._rows(new, self.state.before(spark, done[-1] + 1 if done else 0, of=new))

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_CLOSES).parquet(f"{self.root}/late/*")


_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def indicators_with_state(bars_stream: DataFrame, root: str, delay: str = WATERMARK, trigger=None,
                          layout: Layout = HOURLY) -> Settled:
    """Start T4 below ``root`` (see ``Settled``).  Its operator needs the RocksDB
    state store, which is set for this query alone."""
    conf, job = bars_stream.sparkSession.conf, Settled(root, layout)
    before = conf.get(_STORE)
    conf.set(_STORE, _ROCKS)
    try:  # the query takes a copy of the settings when it starts
        run(state.settle(bars_stream, delay, layout), root, foreach_batch=job, trigger=trigger)
    finally:
        conf.set(_STORE, before)
    return job
