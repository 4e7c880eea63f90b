"""Folds, scalers, sequences, scoring and metrics against loops."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from candlewick.operators import metrics as mt, mlprep as ml

DAY = dt.date(2020, 1, 1)


def _loop_folds(n, plan):
    """Walk forward one step at a time."""
    out, k, fold = [], 0, 0
    while plan.initial + k * plan.stride < n:
        start = plan.initial + k * plan.stride
        train_start = 0 if plan.anchored else k * plan.stride
        if start - train_start >= max(plan.look_back + 1, plan.min_train or 0):
            out.append((fold, train_start, start, start, min(start + plan.window, n)))
            fold += 1
        k += 1
    return out


plans = st.builds(
    ml.WalkForward,
    initial=st.integers(1, 40),
    window=st.integers(1, 15),
    step=st.one_of(st.none(), st.integers(1, 15)),
    look_back=st.integers(1, 10),
    min_train=st.one_of(st.none(), st.integers(1, 60)),
    anchored=st.booleans(),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(plans, st.integers(1, 90))
def test_folds_equal_the_loop(spark, plan, n):
    expected = _loop_folds(n, plan)
    counts = spark.createDataFrame([("a", n)], "ticker string, n long")
    got = ml.fold_table(counts, plan).drop("ticker", "n").orderBy("fold").collect()
    assert [tuple(r) for r in got] == expected

    df = spark.createDataFrame([("a", DAY + dt.timedelta(days=i)) for i in range(n)], "ticker string, date date")
    rows = {(r.fold, r.split, r.row) for r in ml.fold_rows(df, plan).collect()}
    wanted = {(f, "train", i) for f, a, b, _, _ in expected for i in range(a, b)}
    wanted |= {(f, "test", i) for f, _, _, a, b in expected for i in range(a, b)}
    assert rows == wanted


def test_default_folds(spark):
    counts = spark.createDataFrame([("short", 800), ("edge", 801), ("long", 1000)], "ticker string, n long")
    got = {(r.ticker, r.fold): (r.test_start, r.test_end) for r in ml.fold_table(counts, ml.WalkForward()).collect()}
    assert got == {("edge", 0): (800, 801), **{("long", k): (800 + 60 * k, min(860 + 60 * k, 1000)) for k in range(4)}}


def _features(spark, n=30, ticker="a", constant=False):
    rng = np.random.default_rng(n)
    rows = [
        (ticker, DAY + dt.timedelta(days=i), float(rng.uniform(1, 2)), 3.0 if constant else float(i), float(i) / 10)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "ticker string, date date, x double, z double, y double")


def test_scaling_and_back(spark):
    df = _features(spark, constant=True)
    fitted = ml.fit_minmax(df, ["x", "z"])
    scaled = ml.scale(df, fitted, ["x", "z"])
    stats = scaled.agg(F.min("x"), F.max("x"), F.min("z"), F.max("z")).first()
    assert tuple(stats) == (0.0, 1.0, 0.0, 0.0)  # a constant column scales to zero
    back = ml.unscale(scaled, fitted, ["x", "z"]).orderBy("date").toPandas()
    np.testing.assert_allclose(back["x"], df.orderBy("date").toPandas()["x"])


@pytest.mark.parametrize(("rows", "look_back", "stride"), [(12, 5, 1), (12, 5, 3), (5, 5, 1), (6, 5, 2), (3, 5, 1)])
def test_sequences_equal_the_loop(spark, rows, look_back, stride):
    df = _features(spark, rows)
    pdf = df.orderBy("date").toPandas()
    x, y = pdf[["x", "z"]].to_numpy(), pdf["y"].to_numpy()
    expected = [(i, x[i : i + look_back].tolist(), y[i + look_back]) for i in range(0, rows - look_back, stride)]
    got = ml.sequences(df, ["x", "z"], "y", look_back, stride).orderBy("start").collect()
    assert [(r.start, r.inputs, r.target) for r in got] == expected


def test_fold_sequences_stay_inside_their_part(spark):
    """60 test rows and a look-back of 45 leave 15 sequences per full test part; scalers see train rows only."""
    plan = ml.WalkForward(initial=100, window=60, step=60, look_back=45)
    df = _features(spark, 220)
    out = ml.fold_sequences(df, ["x", "z"], plan, "y")
    counts = {(r.fold, r.split): r["count"] for r in out.groupBy("fold", "split").count().collect()}
    assert counts == {(0, "train"): 55, (0, "test"): 15, (1, "train"): 115, (1, "test"): 15}
    last = out.filter("fold = 0 and split = 'test'").orderBy("start").first()
    assert last.inputs[0][1] == pytest.approx(100 / 99)  # row 100 on a scale fitted to rows 0..99


def test_newest_window(spark):
    df = _features(spark, 8).unionByName(_features(spark, 3, "b"))
    with pytest.raises(Exception, match="fewer than 5 rows for b"):
        ml.newest_window(df, ["x", "z"], 5).collect()
    (row,) = ml.newest_window(df, ["x", "z"], 5, short="drop").collect()
    assert row.last_date == DAY + dt.timedelta(days=7) and [v[1] for v in row.inputs] == [3.0, 4.0, 5.0, 6.0, 7.0]


def test_newest_row_without_label_is_scored(spark):
    rows = [("a", DAY + dt.timedelta(days=i), float(i), float(i) if i < 9 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "ticker string, date date, MA_20 double, next_day_return double")
    fitted = ml.fit_minmax(ml.training_rows(df), ["MA_20", "next_day_return"])
    load = lambda: lambda batch: batch[:, -1, 0]
    (r,) = ml.score_newest(df, ["MA_20"], fitted, load, "last", look_back=4).collect()
    assert r.last_data_date == str(DAY + dt.timedelta(days=9))
    assert r.predicted_next_day_return == pytest.approx(9.0) and r.predicted_return_pct == pytest.approx(900.0)
    assert (r.prediction_direction, r.look_back_window, r.features_used) == ("UP", 4, 1)


def test_training_rows_drop_the_unlabelled(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 0.1), ("a", None, 0.1), ("a", 2.0, None), ("b", 1.0, 1.0)], "ticker string, RSI double, next_day_return double"
    )
    assert ml.training_rows(df, "a").count() == 1


def _expected_metrics(a, p):
    err = a - p
    move, guess = np.diff(a), np.diff(p)
    hit = np.sign(move) == np.sign(guess)
    gain = np.where(hit, np.abs(move), -np.abs(move))
    ra, rp = pd.Series(a).rank(), pd.Series(p).rank()
    return {
        "mse": np.mean(err**2),
        "rmse": np.sqrt(np.mean(err**2)),
        "mae": np.mean(np.abs(err)),
        "r2": 1 - np.sum(err**2) / np.sum((a - a.mean()) ** 2),
        "pearson": np.corrcoef(a, p)[0, 1],
        "direction_accuracy": np.mean(hit),
        "sharpe": np.sqrt(252) * gain.mean() / gain.std() if gain.std() > 0 else 0.0,
        "ic": np.corrcoef(ra, rp)[0, 1],
    }


@pytest.fixture(scope="module")
def predictions():
    rng = np.random.default_rng(8)
    frames = []
    for ticker, n in {"hot": 600, "few": 9}.items():
        actual = rng.integers(-5, 6, n).astype(float)  # many ties
        frames.append(
            pd.DataFrame(
                {
                    "ticker": ticker,
                    "fold": np.arange(n) // 60,
                    "row": np.arange(n),
                    "actual": actual,
                    "predicted": (actual + rng.normal(0, 3, n)).round(0),
                }
            )
        )
    return pd.concat(frames, ignore_index=True)


def test_all_metrics(spark, predictions):
    df = spark.createDataFrame(predictions)
    got = mt.evaluate(df).toPandas().set_index("ticker")
    by_parts = (
        mt.regression_metrics(df)
        .join(mt.direction_metrics(df, bucket=F.col("fold")), "ticker")
        .join(mt.spearman(df), "ticker")
        .toPandas()
        .set_index("ticker")
    )
    for ticker, group in predictions.groupby("ticker"):
        for name, value in _expected_metrics(group["actual"].to_numpy(), group["predicted"].to_numpy()).items():
            assert got.loc[ticker, name] == pytest.approx(value, rel=1e-9), name
            assert by_parts.loc[ticker, name] == pytest.approx(value, rel=1e-9), name


def test_no_spread_gives_zero_sharpe(spark):
    rows = [("a", 0, i, float(i), float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "ticker string, fold int, row int, actual double, predicted double")
    r = mt.evaluate(df).first()
    assert (r.sharpe, r.direction_accuracy, r.r2, r.mse) == (0.0, 1.0, 1.0, 0.0)
