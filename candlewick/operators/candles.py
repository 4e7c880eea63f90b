"""Ticks and quotes to candles: in one go, or as partial states that merge later.

Open and close are ordered by ``(timestamp, seq)``, so ties at one instant stay deterministic. Every
aggregate combines map-side: a hot symbol sends at most one row per task and bucket to the shuffle.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions.timefn import bucket_start, month_key

CANDLE = ["symbol", "time_bucket", "open", "high", "low", "close", "volume"]


# Room for any long sequence number below the microseconds.
_SEQ_SPAN = Decimal(10**19)


def moment(ts: str = "timestamp", seq: str | None = "seq") -> Column:
    """Order of a tick: its time, then its sequence number, as one number.

    A number keeps the aggregates hash-based; ordering by a struct would sort every input row first. A tick without a
    sequence number counts as number 0.
    """
    if seq is None:
        return F.col(ts)
    return F.unix_micros(ts).cast("decimal(19,0)") * F.lit(_SEQ_SPAN) + F.coalesce(F.col(seq), F.lit(0)).cast("decimal(19,0)")


def _placed(rows: DataFrame, width: str, seq: str | None, *values: str) -> DataFrame:
    """Rows with their bucket and their moment, each computed once."""
    bucket = bucket_start(F.col("timestamp"), width).alias("time_bucket")
    return rows.select("symbol", bucket, moment(seq=seq).alias("_at"), *values)


def partials(ticks: DataFrame, width: str = "minute", seq: str | None = "seq") -> DataFrame:
    """Mergeable state per symbol and bucket; ``open_at`` and ``close_at`` say which tick won."""
    return _placed(ticks, width, seq, "price", "volume").groupBy("symbol", "time_bucket").agg(
        F.min("_at").alias("open_at"),
        F.min_by("price", "_at").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max("_at").alias("close_at"),
        F.max_by("price", "_at").alias("close"),
        F.sum("volume").alias("volume"),
    )


def merge_partials(states: DataFrame) -> DataFrame:
    """Merge states of the same bucket into one state; associative, so batches may arrive in any split or order."""
    return states.groupBy("symbol", "time_bucket").agg(
        F.min("open_at").alias("open_at"),
        F.min_by("open", "open_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("close_at").alias("close_at"),
        F.max_by("close", "close_at").alias("close"),
        F.sum("volume").alias("volume"),
    )


def read_candles(states: DataFrame) -> DataFrame:
    """Final candles from stored states."""
    return merge_partials(states).select(*CANDLE)


def candles(ticks: DataFrame, width: str = "minute", seq: str | None = "seq") -> DataFrame:
    return partials(ticks, width, seq).select(*CANDLE)


def quote_partials(quotes: DataFrame, width: str = "minute", seq: str | None = None) -> DataFrame:
    """State from quotes: high and low are the extremes of the quotes' own day range, volume counts quotes."""
    placed = _placed(quotes, width, seq, "current_price", "high", "low")
    return placed.groupBy("symbol", "time_bucket").agg(
        F.min("_at").alias("open_at"),
        F.min_by("current_price", "_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("_at").alias("close_at"),
        F.max_by("current_price", "_at").alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def quote_candles(quotes: DataFrame, width: str = "minute", seq: str | None = None) -> DataFrame:
    return quote_partials(quotes, width, seq).select(*CANDLE)


def month_number(moment: datetime | str) -> Column:
    """The month of a time as month-partitioned tables have it. A constant, so that the planner leaves folders out."""
    return month_key(F.lit(moment).cast("timestamp")).cast("int")


def between(df: DataFrame, start: datetime | str, end: datetime | str, symbol: str | None = None) -> DataFrame:
    """Rows of a closed time range, of one symbol if given. Plain predicates, so they reach the scan; a month column ``ym`` is tested too."""
    if "ym" in df.columns:
        df = df.filter(F.col("ym").between(month_number(start), month_number(end)))
    kept = df.filter(F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return kept if symbol is None else kept.filter(F.col("symbol") == symbol)


def bucket_average(
    df: DataFrame, time: str, value: str, width: str = "day", limit: int | None = None, name: str = "average"
) -> DataFrame:
    """Average per time bucket in time order: of all buckets, or of the first ``limit`` for a report that wants them."""
    out = (
        df.groupBy(bucket_start(F.col(time), width).alias("time_bucket"))
        .agg(F.avg(value).alias(name))
        .orderBy("time_bucket")
    )
    return out if limit is None else out.limit(limit)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
