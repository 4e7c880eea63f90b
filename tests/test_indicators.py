"""Hand-made bars for every edge of the indicators."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick import series as series_module, session as session_module
from candlewick.operators import indicators as ind
from candlewick.schemas import BARS, PRICE_FEATURES

DAY = dt.date(2024, 1, 1)


def _bars(spark, closes: dict[str, list[float]], volume=100.0, spread=1.0):
    rows = [
        (DAY + dt.timedelta(days=i), c, c + spread, c - spread, c, volume, ticker)
        for ticker, series in closes.items()
        for i, c in enumerate(series)
    ]
    return spark.createDataFrame(rows, BARS)


def _rows(df, ticker):
    return sorted((r for r in df.collect() if r.ticker == ticker), key=lambda r: r.date)


def test_single_row(spark):
    row = _rows(ind.indicator_set(_bars(spark, {"a": [5.0]}), keep=None), "a")[0]
    assert row.BB_width is None and row.Return is None and row.RSI is None and row.ROC is None
    assert row.MA_200 == 5.0 and row.EMA_26 == pytest.approx(5.0) and row.OBV == 0.0
    assert row.ATR == 2.0


def test_flat_range_has_no_stochastic(spark):
    out = _rows(ind.stochastic(_bars(spark, {"a": [7.0] * 14}, spread=0.0)), "a")
    assert all(r.Stoch_K is None for r in out)


def test_constant_and_rising_rsi(spark):
    out = ind.rsi(_bars(spark, {"flat": [3.0] * 5, "up": [1.0, 2.0, 3.0, 4.0]}))
    assert all(r.RSI is None for r in _rows(out, "flat"))
    assert [r.RSI for r in _rows(out, "up")] == [None, 100.0, 100.0, 100.0]


def test_zero_previous_close(spark):
    out = _rows(ind.returns(_bars(spark, {"a": [0.0, 4.0, 2.0]})), "a")
    assert out[1].Return is None and out[1].Log_Return is None
    assert out[2].Return == -0.5 and out[2].Log_Return == pytest.approx(math.log(0.5))


def test_zero_volume(spark):
    out = _rows(ind.vwap(_bars(spark, {"a": [1.0, 2.0]}, volume=0.0)), "a")
    assert [r.VWAP for r in out] == [None, None]


def test_tickers_do_not_mix(spark):
    alone = _rows(ind.sma(_bars(spark, {"a": [1.0, 2.0, 3.0]})), "a")
    mixed = _rows(ind.sma(_bars(spark, {"a": [1.0, 2.0, 3.0], "b": [100.0] * 3})), "a")
    assert alone == mixed


def test_partial_averages(spark):
    out = _rows(ind.sma(_bars(spark, {"a": [1.0, 2.0, 6.0]})), "a")
    assert [r.MA_200 for r in out] == [1.0, 1.5, 3.0]


def test_obv_signs(spark):
    out = _rows(ind.obv(_bars(spark, {"a": [5.0, 6.0, 6.0, 4.0]}, volume=10.0)), "a")
    assert [r.OBV for r in out] == [0.0, 10.0, 10.0, 0.0]
    assert [r.OBV_change for r in out] == [None, 10.0, 0.0, -10.0]


def test_macd_signal_is_ema_of_macd(spark):
    closes = np.random.default_rng(0).uniform(10, 20, 300).tolist()
    out = pd.DataFrame([r.asDict() for r in _rows(ind.macd(_bars(spark, {"a": closes})), "a")])
    close = pd.Series(closes)
    line = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
    signal = line.ewm(span=9, adjust=False).mean()
    np.testing.assert_allclose(out["MACD"], line, atol=1e-9)
    np.testing.assert_allclose(out["MACD_signal"], signal, atol=1e-9)
    np.testing.assert_allclose(out["MACD_hist"], line - signal, atol=1e-9)


def test_macd_needs_distinct_spans(spark):
    with pytest.raises(ValueError):
        ind.macd(_bars(spark, {"a": [1.0]}), signal=12)


def test_set_equals_single_indicators(spark):
    bars = _bars(spark, {"a": np.random.default_rng(5).uniform(10, 20, 60).tolist(), "b": [4.0, 5.0, 3.0]})
    whole = ind.indicator_set(bars, keep=None).toPandas().set_index(["ticker", "date"]).sort_index()
    steps = [ind.sma, ind.ema, ind.macd, ind.rsi, ind.stochastic, ind.roc, ind.bollinger, ind.atr, ind.obv, ind.vwap]
    steps += [ind.volume_average, ind.returns, ind.price_changes]
    for step in steps:
        part = step(bars).toPandas().set_index(["ticker", "date"]).sort_index()
        for column in part.columns.intersection(whole.columns):
            np.testing.assert_allclose(
                part[column].astype(float), whole[column].astype(float), rtol=1e-9, atol=1e-9, err_msg=column
            )
    assert set(PRICE_FEATURES) <= set(whole.columns)


@pytest.mark.parametrize("block_rows", [200, 230, 100000])
def test_set_in_blocks_equals_whole_set(spark, block_rows):
    closes = np.random.default_rng(2).uniform(10, 20, 900).round(2)
    closes[300:420] = 15.0  # a long flat stretch
    bars = _bars(spark, {"a": closes.tolist(), "b": [4.0, 5.0, 3.0], "c": [1.0]})
    whole = ind.indicator_set(bars, keep=None).toPandas().set_index(["ticker", "date"]).sort_index()
    out = ind.indicator_set_any_size(bars, keep=None, block_rows=block_rows)
    parts = out.toPandas().set_index(["ticker", "date"]).sort_index()
    assert set(parts.columns) == set(whole.columns) and len(parts) == len(whole)
    for column in whole.columns:
        np.testing.assert_allclose(
            parts[column].astype(float), whole[column].astype(float), rtol=1e-9, atol=1e-9, err_msg=column
        )


def test_forward_label(spark):
    out = _rows(ind.forward_label(ind.returns(_bars(spark, {"a": [1.0, 2.0, 3.0]}))), "a")
    assert [r.next_day_return for r in out] == [1.0, 0.5, None]


def test_set_needs_one_shuffle(spark):
    bars = _bars(spark, {"a": [1.0, 2.0]})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ind.indicator_set(bars)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Pandas" not in plan


def test_a_task_holds_a_bounded_number_of_rows(spark, monkeypatch):
    """However many keys there are: the tasks of the windows follow the rows, and Spark does not join them again."""
    monkeypatch.setattr(series_module, "TASK_ROWS", 100)
    bars = _bars(spark, {f"k{i}": [float(i + j) for j in range(20)] for i in range(60)})
    assert ind.indicator_set(bars).rdd.getNumPartitions() == 12
    blocks = ind.indicator_set_any_size(bars, block_rows=300)
    assert blocks.rdd.getNumPartitions() == 12 and blocks.count() == bars.count()


def test_blocks_compute_no_window_twice(spark):
    """The signal line reads features that were written, not windows over windows."""
    bars = _bars(spark, {"a": [float(j + 1) for j in range(50)]})
    plan = ind.indicator_set_any_size(bars, block_rows=300)._jdf.queryExecution().optimizedPlan().toString()
    assert "stddev_samp" not in plan


def test_blocks_keep_only_their_features_and_do_not_shuffle_them(spark, monkeypatch, tmp_path):
    """Of all tables on the way only what the result reads stays, dealt to its tasks as it lies; NULL keys included."""
    folder = lambda _, purpose: f"{tmp_path}/{purpose}-{len(list(tmp_path.iterdir()))}"
    for module in (session_module, series_module):
        monkeypatch.setattr(module, "shared_dir", folder)
    monkeypatch.setattr(series_module, "TASK_ROWS", 100)
    closes = np.random.default_rng(3).uniform(10, 20, 700).round(2).tolist()
    bars = _bars(spark, {"a": closes, "none": closes[::-1], **{f"k{i}": closes[i : i + 20] for i in range(30)}})
    bars = bars.withColumn("ticker", F.when(F.col("ticker") != "none", F.col("ticker")))
    out = ind.indicator_set_any_size(bars, keep=None, block_rows=210)
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"cells", "features"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "REPARTITION" not in plan
    assert not [t for t in spark.catalog.listTables("default") if t.name.startswith(("blocks_", "features_"))]
    order = ["ticker", "date"]
    parts, whole = (x.toPandas().fillna({"ticker": ""}).set_index(order).sort_index() for x in (out, ind.indicator_set(bars, keep=None)))
    assert len(parts) == len(whole) == 2_000 and set(parts.columns) == set(whole.columns)
    for column in whole.columns:
        np.testing.assert_allclose(parts[column].astype(float), whole[column].astype(float), rtol=1e-9, atol=1e-9, err_msg=column)
