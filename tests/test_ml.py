"""Models against numpy and against themselves after a round trip."""

import numpy as np

from tests.conftest import SF_SMALL
from tidemark.operators import ml
from tidemark.operators import mlprep as mp
from tidemark.operators.ema import horizon
from tidemark.plans import q_ml, q_stream


def _key(pdf):
    return pdf.sort_values(["series", "bar_ts"]).reset_index(drop=True)


def test_predictions_match_least_squares(spark):
    model, train, test = q_ml._lr(spark, SF_SMALL)
    cols = model.stages[0].getInputCols()
    tr, te = train.toPandas(), _key(test.toPandas())
    design = np.c_[np.ones(len(tr)), tr[cols].to_numpy(float)]
    beta = np.linalg.lstsq(design, tr["close"].to_numpy(float), rcond=None)[0]
    want = np.c_[np.ones(len(te)), te[cols].to_numpy(float)] @ beta
    got = _key(q_ml.lr_predict(spark, SF_SMALL).toPandas())
    assert np.abs(got["prediction"] - want).max() < 1e-3 * np.abs(want).max()
    report = q_ml.lr_evaluate(spark, SF_SMALL).first()
    rmse = np.sqrt(np.mean((te["close"] - want) ** 2))
    assert abs(report.rmse_test - rmse) < 1e-3 * max(1.0, te["close"].abs().max())
    assert 0.9 < report.r2_train <= 1.0
    names = {r.feature for r in q_ml.linear_regression(spark, SF_SMALL).collect()}
    assert names == {*cols, "intercept"}


def test_stream_scores_like_batch(spark):
    stream, batch = q_stream.scored_both_ways(spark, SF_SMALL)
    got, want = _key(stream.toPandas()), _key(batch.select(*stream.columns).toPandas())
    assert len(got) and got.equals(want)


def test_boosting_stops_on_a_planted_overfit(spark):
    """The training rows hold noise that the validation rows contradict."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 6))
    signal = np.where(x[:, 0] > 0, 1.0, -1.0)
    rows = [(list(map(float, a)), float(b)) for a, b in zip(x, signal + rng.normal(scale=1.5, size=300), strict=True)]
    df = spark.createDataFrame(rows, "window array<double>, target double").persist()
    train, valid = df.limit(150), df.subtract(df.limit(150))
    stopped = ml.sequence_boosting(train, valid, max_iter=30, depth=4)
    assert stopped.stages[0].getNumTrees < 30
    # with validation rows that agree with the training rows there is no reason to stop so early
    agreed = ml.sequence_boosting(train, train, max_iter=30, depth=4, tolerance=0.0)
    assert agreed.stages[0].getNumTrees > stopped.stages[0].getNumTrees

    def error(model):
        pred = ml.sequence_predict(model, valid).toPandas()
        return float(((pred.prediction - pred.target) ** 2).mean())
    assert error(stopped) < error(agreed)


def test_penalty_is_chosen_on_validation_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 30))
    y = x[:, 0] + rng.normal(scale=2.0, size=60)
    rows = [(list(map(float, a)), float(b)) for a, b in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "window array<double>, target double")
    train, valid = df.limit(35), df.subtract(df.limit(35))
    chosen = ml.sequence_regression(train, valid, penalties=(0.0, 5.0)).stages[0].getRegParam()
    errors = {}
    for p in (0.0, 5.0):
        pred = ml.sequence_predict(ml.sequence_regression(train, penalties=(p,)), valid).toPandas()
        errors[p] = float(((pred.prediction - pred.target) ** 2).mean())
    assert chosen == min(errors, key=errors.get)


def test_hash_split_of_wide_keys(spark):
    keys = [0, 1, 12345, 3_469_999_999, 4_000_000_000, 2 ** 40 + 17, 2 ** 63 - 1, -5]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.split for r in mp.hash_split(df, "k").collect()}
    assert got == {k: "train" if (k % 2 ** 32 * mp.HASH_MULT + 42) % mp.HASH_MOD % 100 < 80 else "test" for k in keys}


def test_horizon_grows_with_span():
    assert horizon(1) == 1 and horizon(5) < horizon(26) < horizon(2000)
