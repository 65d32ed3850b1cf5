"""Profiling and cleaning against numpy / pandas."""

import numpy as np
import pandas as pd

from tests.conftest import SF_MID
from tidemark.functions.quantiles import ACCURACY, exact_quantiles
from tidemark.operators import quality as ql
from tidemark.operators.ordered import Layout
from tidemark.plans import fixtures as fx


def test_exact_quantiles_sketch_path_large_group(spark):
    li = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(
        "l_linestatus", "l_extendedprice")
    got = exact_quantiles(li, ["l_linestatus"], "l_extendedprice", [0.25, 0.5, 0.75, 0.9]) \
        .toPandas()
    pdf = li.toPandas()
    assert pdf.groupby("l_linestatus").size().max() > 2 * ACCURACY
    for _, r in got.iterrows():
        want = pdf[pdf.l_linestatus == r.l_linestatus].l_extendedprice.quantile(r.p)
        assert abs(r.q - want) < 1e-9 * max(1.0, abs(want))


def test_interpolate_and_ffill_across_chunks(spark):
    lay = Layout(chunk_rows=50)
    nb = fx.with_nulls(fx.bars_hourly(spark, SF_MID))
    pdf = nb.toPandas().sort_values(["series", "bar_ts"])
    inter = ql.interpolate_linear(nb, ["close"], lay).toPandas().sort_values(["series", "bar_ts"])
    ff = ql.forward_fill(nb, ["close"], lay).toPandas().sort_values(["series", "bar_ts"])
    for s, g in pdf.groupby("series"):
        want_i = g["close"].reset_index(drop=True).interpolate()
        want_f = g["close"].reset_index(drop=True).ffill()
        got_i = inter[inter.series == s]["close"].reset_index(drop=True)
        got_f = ff[ff.series == s]["close"].reset_index(drop=True)
        assert np.allclose(got_i, want_i, equal_nan=True, atol=1e-9)
        assert np.allclose(got_f, want_f, equal_nan=True)


def test_describe_matches_pandas(spark):
    bars = fx.bars_hourly(spark, SF_MID)
    got = ql.describe(bars, ["series"], ["close"]).toPandas()
    pdf = bars.toPandas()
    for _, r in got.iterrows():
        d = pdf[pdf.series == r.series]["close"].describe()
        assert r["count"] == d["count"]
        for ours, theirs in [("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"),
                             ("p75", "75%"), ("min", "min"), ("max", "max")]:
            assert abs(r[ours] - d[theirs]) < 1e-9 * max(1, abs(d[theirs])), ours


def test_duplicates(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    doubled = ev.unionByName(ev.filter("event_type = 'error'"))
    dc = ql.duplicate_count(doubled).first()
    assert dc["duplicates"] == ev.filter("event_type = 'error'").count()
    n_err = ev.filter("event_type = 'error'").count()
    assert ql.duplicate_rows(doubled, doubled.columns, "event_id").count() == n_err
    assert ql.duplicate_rows(doubled).count() == n_err
    tripled = doubled.unionByName(ev.filter("event_type = 'error'"))
    assert ql.duplicate_rows(tripled).count() == 2 * n_err


def test_histogram_counts_all_rows(spark):
    bars = fx.bars_hourly(spark, SF_MID)
    h = ql.histogram(bars, ["series"], "close", 50).toPandas()
    assert h.groupby("series")["count"].sum().to_dict() == \
        bars.groupBy("series").count().toPandas().set_index("series")["count"].to_dict()
    assert (h.groupby("series").size() == 50).all()


def test_kde_integrates_to_one(spark):
    bars = fx.bars_hourly(spark, SF_MID)
    k = ql.kde_grid(bars, ["series"], "close").toPandas()
    for _, g in k.groupby("series"):
        g = g.sort_values("x")
        area = np.trapezoid(g["density"], g["x"])
        assert 0.98 < area < 1.01


def test_correlations_of_many_keys(spark, monkeypatch):
    """Keys dealt out in parts, gatherings of any size and a null key give pandas' values."""
    from tidemark.operators import correlation as co
    from tidemark.operators import moments
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.normal(size=(900, 4)), columns=list("abcd"))
    pdf["b"] = pdf["a"] * 2 + rng.normal(size=900) * 0.1
    pdf["d"] = 5.0
    pdf.loc[rng.random(900) < 0.2, "c"] = np.nan
    pdf["s"] = np.where(np.arange(900) < 500, "hot", np.where(rng.random(900) < 0.1, None, (np.arange(900) % 90).astype(str)))
    df = spark.createDataFrame(pdf.astype({"s": object})).repartition(5)
    monkeypatch.setattr(moments, "GATHERED", 300)
    monkeypatch.setattr(co, "_SPLIT", 100)
    for many in (False, True):
        got = co.corr_long(df, ["s"], list("abcd"), many).toPandas()
        for s, own in pdf.groupby("s", dropna=False):
            want = own[list("abcd")].corr(min_periods=2)
            part = got[got.s.isna()] if s is None or s != s else got[got.s == s]
            for r in part.itertuples():
                both = own[[r.column_1, r.column_2]].dropna()
                assert r.n == len(both)
                w = want.loc[r.column_1, r.column_2]
                if "d" in (r.column_1, r.column_2) or len(both) < 2 or np.isnan(w):
                    assert r.correlation is None or np.isnan(r.correlation)
                else:
                    assert abs(r.correlation - w) < 1e-9
