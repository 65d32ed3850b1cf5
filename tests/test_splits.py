"""Splits: deterministic hash split, exact chronological split sizes."""

from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tidemark.operators import mlprep as mp
from tidemark.plans import fixtures as fx


def test_hash_split_is_deterministic_and_near_fraction(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").select("event_id")
    a = mp.hash_split(ev, "event_id").toPandas().sort_values("event_id")
    b = mp.hash_split(ev.repartition(7), "event_id").toPandas().sort_values("event_id")
    assert (a["split"].to_numpy() == b["split"].to_numpy()).all()   # independent of partitioning
    share = (a["split"] == "train").mean()
    assert 0.77 < share < 0.83


def test_chrono_split_sizes(spark):
    bars = fx.bars_hourly(spark, SF_MID)
    sp = mp.chrono_split(bars).groupBy("series").agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("split") == "train", F.col("bar_ts"))).alias("last_train"),
        F.min(F.when(F.col("split") == "test", F.col("bar_ts"))).alias("first_test")).toPandas()
    for _, r in sp.iterrows():
        assert r["train"] == int(0.8 * r["n"])
        assert r["last_train"] < r["first_test"]                  # train strictly precedes test
