"""Registered source / sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import fixtures as fx
from tidemark.plans import sqlparts as q
from tidemark.plans.catalog import finish, register
from tidemark.session import shared_dir
from tidemark.sources.files import read_bars, read_bars_checked, write_run, write_table

BD = ["open", "high", "low", "close"]


# CSV with header, read back under the declared bar schema
@register("scan_bars", q.BARS_HOURLY, BD)
def scan_bars(spark, sf):
    path = shared_dir(spark, "csv_bars")
    write_table(fx.bars_hourly(spark, sf), path, fmt="csv")
    return finish(read_bars(spark, path, fmt="csv"))


# A price file as data providers write it: one series, capitalised names, another column order
@register("scan_price_csv", f"SELECT 'R' AS series, bar_ts, open, high, low, close, CAST(volume AS BIGINT) AS volume, "
          f"close AS adj_close FROM ({q.BARS_DAILY}) WHERE series = 'R'", [*BD, "adj_close"])
def scan_price_csv(spark, sf):
    path = shared_dir(spark, "csv_prices")
    bars = fx.bars_daily(spark, sf).where("series = 'R'")
    write_table(bars.select(
        F.col("volume").alias("Volume"), F.date_format("bar_ts", "yyyy-MM-dd").alias("Date"),
        F.col("close").alias("Adj Close"), F.col("close").alias("Close"), F.col("open").alias("Open"),
        F.col("low").alias("Low"), F.col("high").alias("High")), path, fmt="csv")
    return finish(read_bars(spark, path, series="R"))


# Files with good and bad lines: the bars, and each bad line in the side table
_MIDNIGHT = f"(SELECT * FROM ({q.BARS_HOURLY}) WHERE hour(bar_ts) < 3)"
_BAD_LINE = ("CASE hour(bar_ts) WHEN 0 THEN series || ',' || strftime(bar_ts, '%d.%m.%Y') || ',1,2,1,2,5' "
             "WHEN 1 THEN series || ',' || strftime(bar_ts, '%Y-%m-%d') || ',cut off' "
             "ELSE series || ',' || strftime(bar_ts, '%Y-%m-%d') || ',n/a,2,1,?,5' END")
_REASON = ("CASE hour(bar_ts) WHEN 0 THEN 'not readable: bar_ts' WHEN 1 THEN 'fields' "
           "ELSE 'not readable: open, close' END")


@register("scan_bars_checked", f"SELECT *, NULL AS line, NULL AS reason FROM ({q.BARS_HOURLY}) UNION ALL BY NAME "
          f"SELECT {_BAD_LINE} AS line, {_REASON} AS reason FROM {_MIDNIGHT}", BD)
def scan_bars_checked(spark, sf):
    path = shared_dir(spark, "csv_checked")
    bars = fx.bars_hourly(spark, sf)
    write_table(bars, f"{path}/good", fmt="csv")
    hour, day = F.hour("bar_ts"), F.date_format("bar_ts", "yyyy-MM-dd")
    bad = F.when(hour == 0, F.concat("series", F.lit(","), F.date_format("bar_ts", "dd.MM.yyyy"), F.lit(",1,2,1,2,5"))).when(
        hour == 1, F.concat("series", F.lit(","), day, F.lit(",cut off"))).otherwise(
        F.concat("series", F.lit(","), day, F.lit(",n/a,2,1,?,5")))
    bars.where(hour < 3).select(bad.alias("value")).write.text(f"{path}/bad")
    good, rejected = read_bars_checked(spark, f"{path}/*")
    return finish(good.unionByName(rejected.drop("file"), allowMissingColumns=True))


# Partitioned parquet round trip
@register("sink_roundtrip", q.BARS_HOURLY, BD)
def sink_roundtrip(spark, sf):
    path = shared_dir(spark, "parquet_bars")
    write_table(fx.bars_hourly(spark, sf), path, fmt="parquet", partition_by=["series"])
    return finish(spark.read.parquet(path).select(
        "series", "bar_ts", "open", "high", "low", "close", "volume"))


# Days written by three runs, of which the second is started twice and the third is that of the first again
@register("sink_runs", q.BARS_HOURLY, BD)
def sink_runs(spark, sf):
    path = shared_dir(spark, "parquet_runs")
    bars = fx.bars_hourly(spark, sf).withColumn("day", F.to_date("bar_ts"))
    old = bars.where(F.dayofyear("day") % 2 == 0)
    write_run(old.withColumn("close", F.lit(0.0)), path, ["day"], "1")
    for _ in range(2):
        write_run(bars, path, ["day"], "2")
    write_run(old.withColumn("close", F.lit(-1.0)), path, ["day"], "1")
    return finish(spark.read.parquet(path).select("series", "bar_ts", "open", "high", "low", "close", "volume"))
