"""Blocks, running totals and recurrences against straightforward pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import indicators as ind
from candlewick.operators.recurrence import carried_ema, chunk_rows, ema_any_size
from candlewick.series import TICKS, Series, main_rows, running_total, split


def _ticks(sizes: dict[str, int], seed: int = 3) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    frames = []
    for symbol, n in sizes.items():
        seconds = np.sort(rng.integers(0, 36000, n))
        frames.append(
            pd.DataFrame(
                {
                    "symbol": symbol,
                    "timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(seconds, unit="s"),
                    "seq": np.arange(n),
                    "price": rng.uniform(1, 100, n).round(2),
                }
            )
        )
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="module")
def ticks():
    # One symbol holds most rows, others a handful.
    return _ticks({"hot": 4000, "warm": 300, "one": 1, "two": 2})


def _by_symbol(frame):
    return {s: g.sort_values("seq").reset_index(drop=True) for s, g in frame.groupby("symbol")}


def _bucket(unit):
    return None if unit is None else F.date_trunc(unit, "timestamp")


@pytest.mark.parametrize(("block_rows", "bucket"), [(20, "minute"), (37, None), (500, "minute"), (500, None), (100000, None)])
def test_blocked_frames_equal_whole_frames(spark, ticks, block_rows, bucket):
    df = spark.createDataFrame(ticks)
    out = ind.tick_indicators(df, TICKS, n=20, bucket=_bucket(bucket), block_rows=block_rows).toPandas()
    assert len(out) == len(ticks)
    for symbol, mine in _by_symbol(out).items():
        price = _by_symbol(ticks)[symbol]["price"]
        np.testing.assert_allclose(mine["MA_20"], price.rolling(20, min_periods=1).mean(), rtol=1e-12)
        np.testing.assert_allclose(mine["MAX_20"], price.rolling(20, min_periods=1).max())
        np.testing.assert_allclose(mine["Return"], price.pct_change(), rtol=1e-9)


def test_blocks_are_bounded(spark, ticks):
    df = spark.createDataFrame(ticks)
    parts, _ = split(df, TICKS, F.date_trunc("minute", "timestamp"), halo=5, block_rows=50)
    sizes = parts.filter("_main").groupBy("_group").count().toPandas()
    chosen, _ = split(df, TICKS, block_rows=400)
    groups = [r["count"] for r in chosen.groupBy("_group").count().collect()]
    assert sum(groups) == len(ticks) and max(groups) < 600 and len(groups) > 8
    assert sizes["count"].max() <= 2 * 50
    assert sizes["count"].sum() == len(ticks)


def _uneven(instant: int = 20_000) -> pd.DataFrame:
    """One key with an outlier of 1970, a burst within a second, many rows at one instant, missing times, and sparse rows."""
    start = pd.Timestamp("2024-01-01")
    times = [pd.Timestamp("1970-01-01"), *[start + pd.Timedelta(days=k) for k in range(300)]]
    times += [start + pd.Timedelta(microseconds=50 * k) for k in range(15_000)] + [start + pd.Timedelta(hours=7)] * instant + [pd.NaT] * 3_000
    frame = pd.DataFrame({"symbol": "hot", "timestamp": times, "price": np.arange(len(times)) % 97 + 1.0})
    return frame.assign(seq=np.random.default_rng(5).permutation(len(times)))


@pytest.mark.parametrize("block_rows", [1_000, 5_000])
def test_blocks_are_bounded_whatever_the_density(spark, block_rows):
    frame = _uneven()
    df = spark.createDataFrame(frame)
    parts, _ = split(df, TICKS, halo=20, block_rows=block_rows)
    sizes = parts.groupBy("_group").agg(F.count("*").alias("all"), F.sum(F.col("_main").cast("int")).alias("main")).toPandas()
    assert sizes["main"].sum() == len(frame)
    assert sizes["main"].max() <= 2 * block_rows and sizes["all"].max() <= 2.25 * block_rows
    assert len(sizes) >= len(frame) / (2 * block_rows)
    bounds = parts.filter("_main").groupBy("_group._block").agg(F.min(F.struct("timestamp", "seq")).alias("a"), F.max(F.struct("timestamp", "seq")).alias("b"))
    listed = [(r.a, r.b) for r in bounds.orderBy("_block").collect()]
    order = lambda x: (x.timestamp is not None, x.timestamp or 0, x.seq)
    assert all(order(x[1]) < order(y[0]) for x, y in zip(listed, listed[1:]))


def test_frames_over_uneven_series_equal_whole_frames(spark):
    frame = _uneven(4_000).sort_values(["timestamp", "seq"], na_position="first").reset_index(drop=True)
    df = spark.createDataFrame(frame)
    mine = ind.tick_indicators(df, TICKS, n=20, block_rows=1_000).toPandas().sort_values(["timestamp", "seq"], na_position="first")
    np.testing.assert_allclose(mine["MA_20"], frame["price"].rolling(20, min_periods=1).mean(), rtol=1e-12)
    total = running_total(df, {"t": F.col("price")}, TICKS, rows=500).toPandas().sort_values(["timestamp", "seq"], na_position="first")
    np.testing.assert_allclose(total["t"], frame["price"].cumsum(), rtol=1e-12)


def test_rows_without_any_order_stay_together(spark):
    rows = [("a", dt.datetime(2024, 1, 1), 7, 1.0)] * 50
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, seq long, price double")
    parts, _ = split(df, TICKS, block_rows=10)
    assert parts.count() == 50
    named = Series(key=("symbol",), order=("price", "symbol"))
    assert split(df, named, block_rows=10)[0].count() == 50
    with pytest.raises(ValueError):
        split(df, Series(key=("symbol",), order=("symbol",)))


def test_crowded_cells_alone_are_scanned_again(spark, tmp_path, ticks):
    path = str(tmp_path / "t")
    spark.createDataFrame(ticks).write.parquet(path)
    seen = []
    from candlewick import series as module

    original = module._histogram
    module._histogram = lambda rows, *rest: seen.append(rows) or original(rows, *rest)
    try:
        split(spark.read.parquet(path), TICKS, block_rows=100_000)
    finally:
        module._histogram = original
    assert len(seen) == 1  # even data: one scan to count, one to place
    assert set(seen[0].columns) == {"symbol", "_cell", "timestamp", "seq"}


def test_split_keeps_null_keys(spark):
    rows = [(None, dt.datetime(2024, 1, 1, 0, i), i, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, seq long, price double")
    for bucket in ("minute", None):
        parts, _ = split(df, TICKS, _bucket(bucket), halo=1, block_rows=2)
        assert main_rows(parts).count() == 5


def test_halo_must_fit(spark, ticks):
    with pytest.raises(ValueError):
        split(spark.createDataFrame(ticks), TICKS, F.col("timestamp"), halo=10, block_rows=5)


def test_running_total(spark, ticks):
    df = spark.createDataFrame(ticks)
    out = running_total(df, {"total": F.col("price")}, TICKS, rows=100).toPandas()
    for symbol, mine in _by_symbol(out).items():
        np.testing.assert_allclose(mine["total"], _by_symbol(ticks)[symbol]["price"].cumsum(), rtol=1e-12)


@pytest.mark.parametrize(("block_rows", "bucket"), [(64, "minute"), (64, None), (1000, None)])
def test_ema_of_any_size(spark, ticks, block_rows, bucket):
    df = spark.createDataFrame(ticks)
    wanted = {f"E{n}": (F.col("price"), ind.span_alpha(n)) for n in (3, 12, 200)}
    out = ema_any_size(df, wanted, TICKS, _bucket(bucket), block_rows=block_rows).toPandas()
    assert len(out) == len(ticks)
    for symbol, mine in _by_symbol(out).items():
        for n in (3, 12, 200):
            expected = _by_symbol(ticks)[symbol]["price"].ewm(span=n, adjust=False).mean()
            np.testing.assert_allclose(mine[f"E{n}"], expected, rtol=1e-11)


def test_ema_over_many_chunks(spark):
    """alpha 0.9 allows chunks of 260 rows, so 3,000 rows chain a dozen of them."""
    n = 3000
    assert chunk_rows([0.9]) < 300
    price = np.random.default_rng(1).uniform(1, 9, n)
    rows = pd.DataFrame({"ticker": "a", "date": np.arange(n), "close": price})
    out = carried_ema(spark.createDataFrame(rows), {"e": (F.col("close"), 0.9), "slow": (F.col("close"), 0.01)})
    mine = out.toPandas().sort_values("date").reset_index(drop=True)
    np.testing.assert_allclose(mine["e"], pd.Series(price).ewm(alpha=0.9, adjust=False).mean(), rtol=1e-12)
    np.testing.assert_allclose(mine["slow"], pd.Series(price).ewm(alpha=0.01, adjust=False).mean(), rtol=1e-12)


def _with_gaps(n=1_500, seed=2):
    rng = np.random.default_rng(seed)
    price = rng.uniform(1, 9, n)
    price[::7] = np.nan
    price[300:700] = np.nan
    price[1_000:1_400] = np.where(rng.uniform(size=400) < 0.95, np.nan, price[1_000:1_400])
    return pd.DataFrame({"ticker": "a", "date": np.arange(n), "close": price})


def _none(frame):
    return frame.astype(object).where(frame.notna(), None)


@pytest.mark.parametrize("block_rows", [None, 64, 500])
def test_ema_with_gaps(spark, block_rows):
    frame = _with_gaps()
    df = spark.createDataFrame(_none(frame), "ticker string, date int, close double")
    wanted = {f"E{k}": (F.col("close"), a) for k, a in enumerate((0.9, 0.3, 0.05, 0.004))}
    days = Series(key=("ticker",), order=("date",))
    out = carried_ema(df, wanted) if block_rows is None else ema_any_size(df, wanted, days, block_rows=block_rows)
    mine = out.toPandas().sort_values("date").reset_index(drop=True)
    for name, (_, a) in wanted.items():
        expected = frame["close"].ewm(alpha=a, adjust=False).mean()
        assert mine[name].isna().tolist() == expected.isna().tolist()
        np.testing.assert_allclose(mine[name], expected, rtol=1e-10)


def test_series_without_any_value(spark):
    df = spark.createDataFrame([("a", k, None) for k in range(40)] + [("b", 39, 2.0), ("b", 1, None)], "ticker string, date int, close double")
    days = Series(key=("ticker",), order=("date",))
    for out in (carried_ema(df, {"e": (F.col("close"), 0.5)}), ema_any_size(df, {"e": (F.col("close"), 0.5)}, days, block_rows=8)):
        assert {r.e for r in out.filter("ticker = 'a'").collect()} == {None}
        assert [r.e for r in out.filter("ticker = 'b'").orderBy("date").collect()] == [None, 2.0]


@pytest.mark.parametrize("block_rows", [None, 300])
def test_macd_and_rsi_with_gaps(spark, block_rows):
    frame = _with_gaps().iloc[:1_200]
    bars = _none(frame.assign(open=1.0, high=10.0, low=0.5, volume=1.0))
    df = spark.createDataFrame(bars, "ticker string, date int, close double, open double, high double, low double, volume double")
    days = Series(key=("ticker",), order=("date",))
    if block_rows is None:
        out = ind.rsi(ind.macd(df))
    else:
        out = ind.indicator_set_any_size(df, days, keep=["MACD", "MACD_signal", "MACD_hist", "RSI"], block_rows=block_rows)
    mine = out.toPandas().sort_values("date").reset_index(drop=True)
    close = frame["close"]
    line = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
    signal = line.ewm(span=9, adjust=False).mean()
    delta = close.diff()
    up, down = (x.ewm(alpha=1 / 14, adjust=False).mean() for x in (delta.where(delta > 0, 0.0), (-delta).where(delta < 0, 0.0)))
    for name, expected in (("MACD", line), ("MACD_signal", signal), ("MACD_hist", line - signal)):
        np.testing.assert_allclose(mine[name], expected, rtol=1e-8, atol=1e-10)
    known = down > 0
    np.testing.assert_allclose(mine["RSI"][known], (100 - 100 / (1 + up / down))[known], rtol=1e-9)


def test_ema_rejects_bad_alpha():
    with pytest.raises(ValueError):
        chunk_rows([1.0])


def test_several_key_columns(spark):
    rows = [("a", "x", i, float(i)) for i in range(6)] + [("a", "y", i, float(10 * i)) for i in range(6)]
    df = spark.createDataFrame(rows, "k1 string, k2 string, at int, close double")
    series = Series(key=("k1", "k2"), order=("at",))
    out = {(r.k2, r["at"]): r.MA_5 for r in ind.sma(df, [5], series=series).collect()}
    assert out[("x", 5)] == 3.0 and out[("y", 1)] == 5.0
