"""Streaming: late data beyond the watermark is dropped."""

import pandas as pd
from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.streaming import jobs


def test_late_ticks_are_dropped(spark):
    path = shared_dir(spark, "test", "late")
    base = pd.Timestamp("2024-01-01 00:00:00")

    def ticks(rows):
        pdf = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value",
                                          "props"])
        return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    first = [(i, base + pd.Timedelta(minutes=5 * i), 1, "a", float(i), "{}") for i in range(30)]
    ticks(first).coalesce(1).write.mode("append").parquet(path)
    # second file moves the watermark past the first hours (they are emitted);
    # the third brings a tick for the already closed first hour.  Spark only
    # guarantees dropping late rows once their window has been finalised.
    ticks([(100, base + pd.Timedelta(hours=5), 1, "a", 1.0, "{}")]) \
        .coalesce(1).write.mode("append").parquet(path)
    ticks([(101, base + pd.Timedelta(minutes=10), 1, "a", 999.0, "{}")]) \
        .coalesce(1).write.mode("append").parquet(path)
    stream = jobs.stream_source(spark, path, jobs.TICK_SCHEMA, max_files=1)
    _, out = jobs.run(jobs.ohlc_tumbling(stream), shared_dir(spark, "test", "late-job"))
    bars = spark.read.parquet(out).toPandas()
    first_hour = bars[bars.bar_ts == base]
    assert len(first_hour) == 1
    assert first_hour["high"].iloc[0] < 999.0  # the late tick did not reopen the bar


def test_dedup_across_batches(spark):
    path = shared_dir(spark, "test", "dups")
    base = pd.Timestamp("2024-01-01 00:00:00")

    def write(rows):
        pdf = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value",
                                          "props"])
        spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz")) \
            .coalesce(1).write.mode("append").parquet(path)

    first = [(i, base + pd.Timedelta(minutes=i), 1, "a", float(i), "{}") for i in range(10)]
    write(first)
    # the same records again in the next file (a re-delivery within the watermark) plus new ones
    write(first[5:] + [(10 + i, base + pd.Timedelta(minutes=10 + i), 1, "a", 1.0, "{}")
                       for i in range(3)])
    stream = jobs.stream_source(spark, path, jobs.TICK_SCHEMA, max_files=1)
    q, out = jobs.run(jobs.dedup(stream), shared_dir(spark, "test", "dups-job"))
    assert len(q.recentProgress) >= 2
    got = spark.read.parquet(out).toPandas()
    assert sorted(got["event_id"]) == list(range(13))


def _bars(n, start=0, series="a", bump=0.0):
    base = pd.Timestamp("2024-01-01")
    return [(series, base + pd.Timedelta(hours=i), 1.0, 2.0, 0.5, 100.0 + (i * 7) % 11 + bump, 10)
            for i in range(start, start + n)]


def _land(spark, path, rows):
    pdf = pd.DataFrame(rows, columns=jobs.BAR_SCHEMA.names)
    spark.createDataFrame(pdf).select(*[F.col(f.name).cast(f.dataType) for f in jobs.BAR_SCHEMA.fields]) \
        .coalesce(1).write.mode("append").parquet(path)


def _rows(df, cols):
    pdf = df.toPandas().sort_values(["series", "bar_ts"])[cols].reset_index(drop=True)
    return pdf.round(9)


def _frame(spark, rows, schema=jobs.BAR_SCHEMA):
    pdf = pd.DataFrame(rows, columns=schema.names)
    return spark.createDataFrame(pdf).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


COLS = ["series", "bar_ts", "close", "sma_5", "sma_20", "ema_5", "ema_20", "rsi"]


def test_indicators_redelivery_retry_and_restart(spark):
    from tidemark.operators.indicators import realtime_features
    path, root = shared_dir(spark, "test", "bars"), shared_dir(spark, "test", "t3")
    job = None
    # the second delivery repeats and revises known bars; each run is a restart on the same root
    for rows in (_bars(30), _bars(10, 20, bump=5.0) + _bars(10, 30), _bars(12, series="b")):
        _land(spark, path, rows)
        job = jobs.indicators_per_batch(jobs.stream_source(spark, path, jobs.BAR_SCHEMA), root)
    final = _bars(20) + _bars(10, 20, bump=5.0) + _bars(10, 30) + _bars(12, series="b")
    want = _rows(realtime_features(_frame(spark, final)), COLS)
    pd.testing.assert_frame_equal(_rows(job.result(spark), COLS), want, check_dtype=False)
    job(_frame(spark, _bars(12, series="b")), 2)  # the last batch runs again
    job(_frame(spark, _bars(0)[:0] or _bars(1)).limit(0), 3)  # and an empty one
    pd.testing.assert_frame_equal(_rows(job.result(spark), COLS), want, check_dtype=False)
    job.compact(spark)
    pd.testing.assert_frame_equal(_rows(job.result(spark), COLS), want, check_dtype=False)


def test_revisions_of_every_age(spark):
    """Series s<k> of 150 bars gets its k-th last bar again: rows as in a batch,
    or a row in the side table where too little is known before it."""
    from tidemark.operators.indicators import realtime_features
    job = jobs.PerBatch(shared_dir(spark, "test", "ages"), realtime_features)
    job.state.every = 2  # generations, and deltas before and after them
    ages = range(1, 141)
    first = [r for k in ages for r in _bars(150, series=f"s{k}")]
    again = [(*_bars(1, 150 - k, series=f"s{k}", bump=50.0)[0],) for k in ages]
    job(_frame(spark, first), 0)
    job(_frame(spark, _bars(3, series="other")), 1)
    for _ in range(2):  # and the same batch again
        job(_frame(spark, again), 2)
    kept = {r[:2]: r for r in first + _bars(3, series="other")}
    kept |= {r[:2]: r for k, r in zip(ages, again, strict=True) if k <= jobs.REVISED}
    want = _rows(realtime_features(_frame(spark, list(kept.values()))), COLS)
    pd.testing.assert_frame_equal(_rows(job.result(spark), COLS), want, check_dtype=False)
    assert {r.series for r in job.late(spark).collect()} == {f"s{k}" for k in ages if k > jobs.REVISED}
    written = spark.read.parquet(f"{job.root}/state/delta=2")  # its own series only
    assert {r.series for r in written.select("series").distinct().collect()} == {f"s{k}" for k in ages if k <= 100}


def test_state_keeps_two_generations(spark):
    from tidemark.streaming import state
    held = state.BarState(shared_dir(spark, "test", "gens"), jobs.BAR_SCHEMA, keep=5, lookback=2, every=2)
    for n in range(7):
        rows = _frame(spark, _bars(4, 4 * n, series="ab"[n % 2]))
        known = held.before(spark, n, of=rows)
        held.write(n, known.drop("cut").unionByName(rows), known)
    assert state.numbered(spark, held.root, "gen") == [4, 6]
    assert state.numbered(spark, held.root, "delta") == [4, 5, 6]
    for n in (5, 6, 7):  # also batches that run again find their state
        got = {(r.series, r.bar_ts, r.cut) for r in held.before(spark, n).collect()}
        for s in "ab":
            times = [r[1] for k in range(n) if "ab"[k % 2] == s for r in _bars(4, 4 * k)][-5:]
            assert {x[1] for x in got if x[0] == s} == set(times)
            assert {x[2] for x in got if x[0] == s} == {times[2]}


def test_very_late_bars_are_set_aside(spark):
    path, root = shared_dir(spark, "test", "bars"), shared_dir(spark, "test", "t3")
    _land(spark, path, _bars(150, 10))
    jobs.indicators_per_batch(jobs.stream_source(spark, path, jobs.BAR_SCHEMA), root)
    _land(spark, path, _bars(1, 0) + _bars(1, 160))
    job = jobs.indicators_per_batch(jobs.stream_source(spark, path, jobs.BAR_SCHEMA), root)
    assert job.result(spark).count() == 151
    assert job.late(spark).count() == 1


def test_bars_job_starts_again(spark):
    """Two and three runs on one root, the second in the hour that the first left
    open: bars as of all ticks."""
    path, root = shared_dir(spark, "test", "ticks"), shared_dir(spark, "test", "t1")
    base = pd.Timestamp("2024-01-01 00:00:00")
    rows = [(i, base + pd.Timedelta(minutes=10 * i), 1, "a", float(i % 7), "{}") for i in range(40)]
    for a, b in ((0, 20), (20, 22), (21, 40)):  # the last one brings tick 21 again
        _frame(spark, rows[a:b], jobs.TICK_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        bars = spark.read.schema(jobs.BAR_SCHEMA).parquet(jobs.bars_job(spark, path, root, once=True)).toPandas()
        want = pd.DataFrame(rows[:b], columns=jobs.TICK_SCHEMA.names).set_index("ts").resample("1h")["value"].agg(
            ["first", "max", "min", "last", "count"])
        got = bars.set_index("bar_ts").sort_index()[["open", "high", "low", "close", "volume"]]
        assert got.index.is_unique and (got.to_numpy() == want.to_numpy()).all()


def _settled(spark, rows, parts, delay="10 minutes", layout=jobs.HOURLY):
    path, root, job = shared_dir(spark, "test", "bars"), shared_dir(spark, "test", "t4"), None
    for part in parts:
        _land(spark, path, part)
        job = jobs.indicators_with_state(jobs.stream_source(spark, path, jobs.BAR_SCHEMA), root, delay, layout=layout)
    return job, _rows(job.result(spark).unionByName(job.open(spark)), jobs.STATE_OUT.names)


def _expected(rows):
    out = pd.DataFrame([(r[0], r[1], r[5]) for r in rows], columns=["series", "bar_ts", "close"])
    out["close"] = out["close"].astype(float)
    for n in (5, 20):
        out[f"sma_{n}"] = out["close"].rolling(n, min_periods=1).mean()
    for n in (5, 20):
        out[f"ema_{n}"] = out["close"].ewm(span=n, adjust=False).mean()
    delta = out["close"].diff().fillna(0.0)
    gain, loss = (x.clip(lower=0).rolling(14, min_periods=1).mean() for x in (delta, -delta))
    rs = (gain / loss.where(loss != 0)).fillna(0.0)
    out["rsi"] = (100 - 100 / (1 + rs)).where(rs != 0, 0.0)
    return out


def test_state_orders_bars_and_sets_late_ones_aside(spark):
    rows = _bars(40)
    rows[7] = (*rows[7][:5], None, 10)
    rows[38] = (*rows[38][:5], None, 10)
    stray = [("a", None, 1.0, 2.0, 0.5, 1.0, 10)]
    old = [("a", pd.Timestamp("1950-01-01"), 1.0, 2.0, 0.5, 1.0, 10)]
    # out of order inside a delivery; bars seen come again; a bar before all others comes late
    parts = [rows[8:15] + rows[:8], rows[10:30][::-1] + stray, old + rows[30:] + _bars(3, 40)]
    job, got = _settled(spark, rows, parts)
    pd.testing.assert_frame_equal(got.drop(columns="rsi"), _expected(rows + _bars(3, 40)).round(9).drop(columns="rsi"),
                                  check_dtype=False)
    late = [(r.bar_ts, r.close) for r in job.late(spark).collect()]
    # bar 14 was still waiting when it came again; the others had been handed on
    assert sorted(late, key=str) == sorted([(r[1], r[5]) for r in rows[10:14] + stray + old], key=str)


def test_state_with_a_hot_series_in_one_batch(spark):
    """30,000 bars of one series in one micro-batch, handed on by many keys and
    computed in many chunks, then a few more in the next."""
    layout = jobs.Layout(block_seconds=1000 * 3600, chunk_rows=2048)
    rows = _bars(30_100)
    job, got = _settled(spark, rows, [rows[:30_000] + _bars(50, series="b"), rows[29_999:]], layout=layout)
    want = pd.concat([_expected(rows), _expected(_bars(50, series="b"))]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, atol=1e-7)


def test_predictions_meet_later_prices(spark):
    made, seen = shared_dir(spark, "test", "made"), shared_dir(spark, "test", "seen")
    base = pd.Timestamp("2024-01-01")
    h = pd.Timedelta(hours=1)
    kinds = "series string, made_ts timestamp_ntz, target_ts timestamp_ntz, predicted_price double"

    def predict(rows):
        spark.createDataFrame([(s, (base + (t - 1) * h).to_pydatetime(), (base + t * h).to_pydatetime(), p)
                               for s, t, p in rows], kinds).coalesce(1).write.mode(
            "append").parquet(made)
    root, out, kind = shared_dir(spark, "test", "met"), None, None
    # hour 3 of a never comes; b's prediction for hour 2 is met by a bar 40 minutes later, one run after it was made
    steps = [([("a", 1, 110.0), ("a", 3, 1.0), ("b", 2, 50.0)], [("a", 1.0, 100.0), ("b", 1.0, 7.0)]),
             ([("a", 9, 5.0)], [("b", 2 + 2 / 3, 40.0), ("a", 8.0, 0.0)]), ([("a", 8, 3.0)], [("a", 8.5, 3.0)])]
    for predictions, prices in steps:
        predict(predictions)
        _land(spark, seen, [(s, base + t * h, 1.0, 2.0, 0.5, c, 10) for s, t, c in prices])
        joined = jobs.match_predictions(spark.readStream.schema(kinds).parquet(made),
                                        jobs.stream_source(spark, seen, jobs.BAR_SCHEMA), "59 minutes")
        kind = joined.schema
        _, out = jobs.run(joined, root)
    got = sorted((r.series, r.predicted_price, r.actual_price, r.prediction_error_pct)
                 for r in spark.read.schema(kind).parquet(out).collect())
    assert [x[:3] for x in got] == [("a", 1.0, None), ("a", 3.0, 0.0), ("a", 3.0, 3.0), ("a", 110.0, 100.0), ("b", 50.0, 40.0)]
    assert got[3][3] == 10.0 and got[4][3] == 25.0 and got[1][3] is None


def test_counting_with_a_processing_time_trigger(spark):
    path, root = shared_dir(spark, "test", "bars"), shared_dir(spark, "test", "t6")
    _land(spark, path, _bars(30))
    _land(spark, path, _bars(5, 30))
    stream = jobs.stream_source(spark, path, jobs.BAR_SCHEMA, max_files=1)
    counts = jobs.count_input(stream, root, {"processingTime": "1 second"}, drain=True).collect()
    assert sorted(r.num_input_rows for r in counts) == [5, 30]
