"""Technical indicators over ordered series.

Each ``*_column`` function builds a Column for a ``Series``; the DataFrame functions add named columns.
Frames are trailing rows and may be partial at the start of a key. Columns of one dependency level share
one ``select``, so the whole set needs a single shuffle by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions.numeric import pct_change, ratio, safe_log
from candlewick.operators.recurrence import carried_ema, ema_inputs, over_blocks
from candlewick.schemas import PRICE_FEATURES
from candlewick.series import DAILY, GROUP, MAIN, Series, in_tasks, main_rows, split, staged_in_tasks, tasks_of
from candlewick.session import discard, release, staged

# Window lengths of the standard set.
SMA_LENGTHS = (5, 10, 20, 50, 200)
EMA_SPANS = (12, 26, 50, 200)
SIGNAL_SPAN = 9
RSI_LENGTH = 14
STOCHASTIC = (14, 3)
ROC_LENGTH = 12
BOLLINGER = (20, 2)
ATR_LENGTH = 14
VOLUME_LENGTH = 20


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


# --- single columns -------------------------------------------------------------------------------


def previous(value: str, series: Series, rows: int = 1) -> Column:
    return F.lag(value, rows).over(series.window())


def sma_column(value: str, n: int, series: Series = DAILY) -> Column:
    return F.avg(value).over(series.trailing(n))


def extremes(n: int, series: Series = DAILY) -> tuple[Column, Column]:
    return F.min("low").over(series.trailing(n)), F.max("high").over(series.trailing(n))


def stochastic_k_column(low: Column, high: Column) -> Column:
    """Place of the close between the extremes; NULL for a flat range."""
    return ratio(F.col("close") - low, high - low) * 100


def true_range_column(before: Column) -> Column:
    """Widest of the day's range and the moves from the previous close; the day's range on the first row."""
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def signed_volume_column(before: Column) -> Column:
    """Volume with the sign of the close's move; zero on the first row."""
    return F.coalesce(F.signum(F.col("close") - before), F.lit(0.0)) * F.col("volume")


def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


# --- one indicator at a time ------------------------------------------------------------------------


def sma(df: DataFrame, lengths: Sequence[int] = SMA_LENGTHS, price: str = "close", series: Series = DAILY) -> DataFrame:
    return df.select("*", *[sma_column(price, n, series).alias(f"MA_{n}") for n in lengths])


def ema(df: DataFrame, spans: Sequence[int] = EMA_SPANS, price: str = "close", series: Series = DAILY) -> DataFrame:
    """Recursive averages seeded with the first value."""
    wanted = {f"EMA_{n}": (F.col(price), span_alpha(n)) for n in spans}
    return carried_ema(df, wanted, series)


def macd_columns(line: Column, signal: str) -> dict[str, Column]:
    return {"MACD": line, "MACD_signal": F.col(signal), "MACD_hist": line - F.col(signal)}


def macd(
    df: DataFrame, fast: int = 12, slow: int = 26, signal: int = SIGNAL_SPAN, price: str = "close", series: Series = DAILY
) -> DataFrame:
    """Difference of two averages of the price, its own average, and the difference of both. Where a price is missing, the line stands still
    and the signal goes on towards it."""
    if signal in (fast, slow):
        raise ValueError("the signal span must differ from the fast and slow spans")
    numbered = df.select("*", *ema_inputs(series))
    averages = carried_ema(numbered, {"_fast": (F.col(price), span_alpha(fast)), "_slow": (F.col(price), span_alpha(slow))}, series)
    line = F.col("_fast") - F.col("_slow")
    out = carried_ema(averages, {"_signal": (line, span_alpha(signal))}, series)
    return out.select(*df.columns, *[c.alias(n) for n, c in macd_columns(line, "_signal").items()])


def _moves(price: Column, before: Column) -> tuple[Column, Column]:
    """Gain and loss of the last move; zero on the first row."""
    delta = F.coalesce(price - before, F.lit(0.0))
    return F.greatest(delta, F.lit(0.0)), F.greatest(-delta, F.lit(0.0))


def rsi_column(gain: str, loss: str) -> Column:
    """100 when there were only gains, NULL when there was no move at all."""
    average_gain, average_loss = F.col(gain), F.col(loss)
    return F.when((average_loss == 0) & (average_gain > 0), F.lit(100.0)).otherwise(
        100 - 100 / (1 + ratio(average_gain, average_loss))
    )


def rsi(df: DataFrame, n: int = RSI_LENGTH, price: str = "close", series: Series = DAILY) -> DataFrame:
    gain, loss = _moves(F.col(price), previous(price, series))
    moved = df.select("*", gain.alias("_gain"), loss.alias("_loss"))
    wanted = {"_avg_gain": (F.col("_gain"), 1.0 / n), "_avg_loss": (F.col("_loss"), 1.0 / n)}
    out = carried_ema(moved, wanted, series)
    return out.select(*df.columns, rsi_column("_avg_gain", "_avg_loss").alias("RSI"))


def stochastic(df: DataFrame, k: int = STOCHASTIC[0], d: int = STOCHASTIC[1], series: Series = DAILY) -> DataFrame:
    out = df.select("*", stochastic_k_column(*extremes(k, series)).alias("Stoch_K"))
    return out.select("*", sma_column("Stoch_K", d, series).alias("Stoch_D"))


def roc(df: DataFrame, n: int = ROC_LENGTH, price: str = "close", series: Series = DAILY) -> DataFrame:
    return df.select("*", (pct_change(F.col(price), previous(price, series, n)) * 100).alias("ROC"))


def bollinger(
    df: DataFrame, n: int = BOLLINGER[0], width: float = BOLLINGER[1], price: str = "close", series: Series = DAILY
) -> DataFrame:
    frame = series.trailing(n)
    out = df.select("*", F.avg(price).over(frame).alias("BB_middle"), F.stddev_samp(price).over(frame).alias("_sd"))
    upper, lower = F.col("BB_middle") + width * F.col("_sd"), F.col("BB_middle") - width * F.col("_sd")
    return out.select(
        *df.columns, "BB_middle", upper.alias("BB_upper"), lower.alias("BB_lower"), (upper - lower).alias("BB_width")
    )


def atr(df: DataFrame, n: int = ATR_LENGTH, series: Series = DAILY) -> DataFrame:
    ranged = df.select("*", true_range_column(previous("close", series)).alias("true_range"))
    return ranged.select("*", sma_column("true_range", n, series).alias("ATR"))


def obv(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """On-balance volume and its change. Needs a whole (not blocked) series."""
    signed = df.select("*", signed_volume_column(previous("close", series)).alias("_signed"))
    out = signed.select(*df.columns, F.sum("_signed").over(series.running()).alias("OBV"))
    return out.select("*", (F.col("OBV") - previous("OBV", series)).alias("OBV_change"))


def vwap(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Volume-weighted price since the start of the key. Needs a whole (not blocked) series."""
    traded = F.sum(typical_price() * F.col("volume")).over(series.running())
    return df.select("*", ratio(traded, F.sum("volume").over(series.running())).alias("VWAP"))


def volume_average(df: DataFrame, n: int = VOLUME_LENGTH, series: Series = DAILY) -> DataFrame:
    return df.select("*", sma_column("volume", n, series).alias("Volume_MA"))


def returns(df: DataFrame, price: str = "close", series: Series = DAILY) -> DataFrame:
    before = previous(price, series)
    return df.select(
        "*",
        pct_change(F.col(price), before).alias("Return"),
        safe_log(ratio(F.col(price), before)).alias("Log_Return"),
    )


def price_changes(df: DataFrame, series: Series = DAILY) -> DataFrame:
    before = previous("close", series)
    return df.select(
        "*",
        (F.col("close") - before).alias("Price_Change"),
        (pct_change(F.col("close"), before) * 100).alias("Price_Change_Pct"),
        (F.col("high") - F.col("low")).alias("High_Low_Range"),
        (F.col("close") - F.col("open")).alias("Open_Close_Range"),
    )


def forward_label(df: DataFrame, value: str = "Return", name: str = "next_day_return", series: Series = DAILY) -> DataFrame:
    """The next row's value as the label; NULL on the newest row."""
    return df.select("*", F.lead(value, 1).over(series.window()).alias(name))


# --- the whole set ----------------------------------------------------------------------------------


def _trailing(df: DataFrame, series: Series) -> DataFrame:
    """Everything that looks at a bounded number of rows: one level of windows, row arithmetic, a second level."""
    low, high = extremes(STOCHASTIC[0], series)
    windows = df.select(
        "*",
        *[sma_column("close", length, series).alias(f"MA_{length}") for length in SMA_LENGTHS],
        sma_column("volume", VOLUME_LENGTH, series).alias("Volume_MA"),
        F.stddev_samp("close").over(series.trailing(BOLLINGER[0])).alias("_sd"),
        low.alias("_low"),
        high.alias("_high"),
        previous("close", series).alias("_before"),
        previous("close", series, ROC_LENGTH).alias("_long_before"),
    )
    close, before = F.col("close"), F.col("_before")
    gain, loss = _moves(close, before)
    derived = windows.select(
        "*",
        stochastic_k_column(F.col("_low"), F.col("_high")).alias("Stoch_K"),
        (pct_change(close, F.col("_long_before")) * 100).alias("ROC"),
        true_range_column(before).alias("_range"),
        signed_volume_column(before).alias("_signed"),
        pct_change(close, before).alias("Return"),
        safe_log(ratio(close, before)).alias("Log_Return"),
        (close - before).alias("Price_Change"),
        (pct_change(close, before) * 100).alias("Price_Change_Pct"),
        (F.col("high") - F.col("low")).alias("High_Low_Range"),
        (close - F.col("open")).alias("Open_Close_Range"),
        gain.alias("_gain"),
        loss.alias("_loss"),
    )
    return derived.select(
        "*",
        sma_column("Stoch_K", STOCHASTIC[1], series).alias("Stoch_D"),
        sma_column("_range", ATR_LENGTH, series).alias("ATR"),
    )


# Rows before a block that the longest chain of trailing frames can see.
HALO = max(max(SMA_LENGTHS), STOCHASTIC[0] + STOCHASTIC[1], ROC_LENGTH + 1, ATR_LENGTH + 1)


def _averages() -> dict[str, tuple[Column, float]]:
    wanted = {f"EMA_{span}": (F.col("close"), span_alpha(span)) for span in EMA_SPANS}
    wanted["_avg_gain"] = (F.col("_gain"), 1.0 / RSI_LENGTH)
    wanted["_avg_loss"] = (F.col("_loss"), 1.0 / RSI_LENGTH)
    return wanted


def _line() -> Column:
    return F.col("EMA_12") - F.col("EMA_26")


def _signal() -> dict[str, tuple[Column, float]]:
    return {"_signal_line": (_line(), span_alpha(SIGNAL_SPAN))}


def _totals() -> dict[str, Column]:
    return {"OBV": F.col("_signed"), "_traded": typical_price() * F.col("volume"), "_shares": F.col("volume")}


def _settled(df: DataFrame) -> DataFrame:
    """What follows from the averages and totals without the signal line."""
    width = BOLLINGER[1]
    return df.select(
        "*",
        rsi_column("_avg_gain", "_avg_loss").alias("RSI"),
        F.col("MA_20").alias("BB_middle"),
        (F.col("MA_20") + width * F.col("_sd")).alias("BB_upper"),
        (F.col("MA_20") - width * F.col("_sd")).alias("BB_lower"),
        (2 * width * F.col("_sd")).alias("BB_width"),
        ratio(F.col("_traded"), F.col("_shares")).alias("VWAP"),
        F.when(F.col("_before").isNotNull(), F.col("_signed")).alias("OBV_change"),
    )


def _with_macd(df: DataFrame) -> DataFrame:
    return df.select("*", *[c.alias(name) for name, c in macd_columns(_line(), "_signal_line").items()])


def _finished(df: DataFrame, series: Series, keep: Sequence[str] | None) -> DataFrame:
    final = _settled(_with_macd(df))
    if keep is not None:
        return final.select(*series.order, *series.key, *keep)
    return final.select(*[c for c in final.columns if not c.startswith("_")])


def indicator_set(df: DataFrame, series: Series = DAILY, keep: Sequence[str] | None = PRICE_FEATURES) -> DataFrame:
    """All indicators of a daily series after one shuffle by key.

    ``keep`` prunes the result to the model features; ``None`` returns every column. The rows are counted first: the number of tasks
    follows from it, so that the memory of one does not grow with the number of keys.
    """
    df = in_tasks(df, series.partition, df.count())
    running = [F.sum(value).over(series.running()).alias(name) for name, value in _totals().items()]
    rows = _trailing(df, series).select("*", *running, *ema_inputs(series))
    averages = carried_ema(rows, _averages(), series)
    return _finished(carried_ema(averages, _signal(), series), series, keep)


def indicator_set_any_size(
    df: DataFrame,
    series: Series = DAILY,
    keep: Sequence[str] | None = PRICE_FEATURES,
    bucket: Column | None = None,
    block_rows: int = 65536,
) -> DataFrame:
    """The same indicators for bars so fine that one key may outgrow a task (seconds, trades): block by block.

    The bars are written once, since cells and blocks read them, and deleted when the blocks are written; these in turn when the features before
    the signal line are, which averages them again. Otherwise each level would compute the ones below it twice. Blocks and features lie in
    files by task, so that both readings of each need no shuffle.
    """
    spark = df.sparkSession
    bars = staged(df, "bars")
    seen = bars.count()
    tasks = tasks_of(bars, seen)
    finer = tasks * max(1, round((block_rows + HALO) / block_rows))  # a multiple, so that features stay in the tasks of their blocks
    release(spark)
    parts, blocked = split(bars, series, bucket, halo=HALO, block_rows=block_rows)
    parts = staged_in_tasks(parts.repartition(finer, GROUP) if tasks > 1 else parts, [GROUP], finer if tasks > 1 else 1, "blocks")
    discard(bars)
    release(spark)
    rows = _trailing(parts, blocked).filter(MAIN).drop(MAIN)
    averages = over_blocks(rows, blocked, _averages(), _totals())
    final = _finished(averages.withColumn("_signal_line", F.lit(0.0)), series, keep).columns
    settled = _settled(averages)
    needed = dict.fromkeys([GROUP, *series.order, *[c for c in final if c in settled.columns], "EMA_12", "EMA_26"])
    settled = staged_in_tasks(settled.select(*needed), [GROUP], tasks, "features")
    discard(parts)
    release(spark)
    return _with_macd(over_blocks(settled, blocked, _signal())).select(*final)


def tick_indicators(
    df: DataFrame,
    series: Series,
    n: int = 20,
    price: str = "price",
    bucket: Column | None = None,
    block_rows: int = 65536,
) -> DataFrame:
    """Trailing mean, sample deviation, extremes and return of a series of any size, block by block."""
    parts, blocked = split(df, series, bucket, halo=n, block_rows=block_rows)
    frame = blocked.trailing(n)
    out = parts.select(
        "*",
        F.avg(price).over(frame).alias(f"MA_{n}"),
        F.stddev_samp(price).over(frame).alias(f"SD_{n}"),
        F.min(price).over(frame).alias(f"MIN_{n}"),
        F.max(price).over(frame).alias(f"MAX_{n}"),
        pct_change(F.col(price), previous(price, blocked)).alias("Return"),
    )
    return main_rows(out)
