"""Readers with bad lines, writes that are killed, bars that roll up, sketches."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.functions import sketches as sk
from tidemark.operators import quality as ql
from tidemark.plans import fixtures as fx
from tidemark.session import shared_dir
from tidemark.sources import files
from tidemark.sources.bars import BAR_COLUMNS, bar_states, build_bars, roll_up


def test_bad_lines_are_set_aside_once_each(spark):
    path = shared_dir(spark, "test", "lines")
    head = ",".join(f.name for f in files.BAR_SCHEMA.fields)
    good = ["a,2024-01-01T00:00:00,1,2,0.5,1.5,10", "b,2024-01-02,1,2,0.5,,", ",2024-01-03 05:00:00, 1 ,2,0.5,1e3,7"]
    bad = {"a,2024-01-01": "fields", "a,2024-01-01T00:00:00,1,2,0.5,1.5,10,11": "fields",
           "a,yesterday,1,2,0.5,1.5,10": "not readable: bar_ts", "a,2024-01-05,x,2,0.5,1.5,much": "not readable: open, volume"}
    spark.createDataFrame([("\n".join([head, *good, *bad, "", "a,2024-01-01"]),)], "t string").coalesce(1).write.text(path)
    rows, rejected = files.read_bars_checked(spark, path)
    assert rows.schema.simpleString() == files.BAR_SCHEMA.simpleString()
    assert sorted((r.series or "", r.close, r.volume) for r in rows.collect()) == [("", 1000.0, 7), ("a", 1.5, 10), ("b", None, None)]
    got = sorted((r.line, r.reason) for r in rejected.collect())
    assert got == sorted([*bad.items(), ("a,2024-01-01", "fields")])


def test_a_killed_write_leaves_one_copy(spark, monkeypatch):
    path = shared_dir(spark, "test", "runs")
    df = spark.createDataFrame([(d, i) for d in "xyz" for i in range(4)], "day string, n int")
    files.write_run(df.where("day <> 'z'").withColumn("n", F.lit(-1)), path, ["day"], "first")

    def rows():
        return sorted((r.day, r.n) for r in spark.read.parquet(path).collect())
    # killed after the staging folder, then after the partitions, was written
    for stop in ("_complete", "_fs"):
        real, calls = getattr(files, stop), []

        def dying(*a, real=real, calls=calls, stop=stop):
            calls.append(a)
            if stop == "_complete" and len(calls) == 2:
                df.write.mode("overwrite").parquet(a[1])
                raise KeyboardInterrupt
            if stop == "_fs" and "_staging" in a[1] and not a[1].endswith("_SUCCESS"):
                raise KeyboardInterrupt
            return real(*a)
        monkeypatch.setattr(files, stop, dying)
        with pytest.raises(KeyboardInterrupt):
            files.write_run(df, path, ["day"], f"killed-{stop}")
        monkeypatch.setattr(files, stop, real)
        files.write_run(df.withColumn("n", F.col("n") + 0), path, ["day"], f"killed-{stop}")
        assert rows() == sorted(map(tuple, df.collect()))
        assert not files.write_run(df.withColumn("n", F.lit(0)), path, ["day"], f"killed-{stop}")
    assert rows() == sorted(map(tuple, df.collect()))


def test_metrics_written_again_replace_themselves(spark):
    path = shared_dir(spark, "test", "metrics")
    report = spark.createDataFrame([("a", 1.0)], "series string, rmse double")
    stamp = pd.Timestamp("2024-05-01 10:00:00")
    for _ in range(2):
        files.write_metrics(report, path, stamp)
    files.write_metrics(report, path, pd.Timestamp("2024-05-02 10:00:00"))
    assert spark.read.parquet(path).count() == 2


def test_bars_roll_up_with_missing_prices(spark):
    rows = [(i, (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=50 * i)).to_pydatetime(), "ab"[i % 2], None if i % 5 == 0 or i < 9 else
             float(i * 37 % 11)) for i in range(500)]
    ticks = spark.createDataFrame(rows, "id long, ts timestamp, s string, p double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    states = bar_states(ticks, "ts", "p", "s", order=["ts", "id"])
    for grain in ("hour", "day"):
        want = build_bars(ticks.where("p IS NOT NULL"), "ts", "p", "s", grain, ["ts", "id"]).drop("volume")
        got = roll_up(roll_up(states, "hour"), grain).select(*BAR_COLUMNS)
        assert sorted(map(tuple, got.drop("volume").collect())) == sorted(map(tuple, want.collect()))
        assert got.agg(F.sum("volume")).first()[0] == 500


@pytest.mark.parametrize("k", [8, 200])
def test_merged_sketches_keep_their_bound(spark, k):
    rng = np.random.default_rng(k)
    data = pd.DataFrame({"s": rng.choice(["a", "b"], 40_000, p=[0.95, 0.05]), "d": rng.integers(1, 29, 40_000),
                         "x": np.round(rng.lognormal(size=40_000), 2)})
    df = spark.createDataFrame(data).withColumn("ts", F.make_date(F.lit(2024), F.lit(1), "d")).withColumn(
        "x", F.when(F.col("x") > 0.05, F.col("x")))
    days = sk.sketch(df, ["s"], ["x"], day="ts", k=k)
    assert days.count() == 56
    whole = sk.merge(days, ["s"], k)
    found = sk.quantiles(whole, [0.0, 0.1, 0.5, 0.9, 1.0]).drop("n")
    worst = sk.outside_ranks(df, ["s"], ["x"], found).agg(F.max("rank_error")).first()[0]
    assert worst <= sk.rank_error(k)
    data.loc[data.x <= 0.05, "x"] = np.nan
    for r in sk.summary(whole).collect():
        own = data[data.s == r.s].x.dropna()
        assert (r.n, r.low, r.high) == (len(own), own.min(), own.max())
        assert np.allclose([r["mean"], r.stddev], [own.mean(), own.std()], rtol=1e-9)


@pytest.mark.parametrize("error", [1e-2, 1e-4, 1e-6])
def test_binned_density_is_within_its_bound(spark, error):
    bars = fx.bars_hourly(spark, SF_SMALL)
    exact = ql.kde_grid(bars, ["series"], "close").toPandas()
    binned = ql.kde_binned(bars, ["series"], "close", error=error).toPandas()
    both = exact.merge(binned, on=["series", "g"])
    assert len(both) == len(exact) and np.allclose(both.x_x, both.x_y)
    assert ((both.density_x - both.density_y).abs() <= both.bound).all()
    one = spark.createDataFrame([("c", 1.0), ("c", 1.0), ("n", None)], "series string, close double")
    assert ql.kde_binned(one, ["series"], "close").count() == 0
