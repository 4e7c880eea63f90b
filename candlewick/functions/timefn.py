"""Time parsing, zones and buckets. All expect a UTC session."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NEW_YORK = "America/New_York"


def compact_timestamp(text: Column) -> Column:
    """``yyyyMMddHHmmss`` text to timestamp; NULL for bad text."""
    return F.try_to_timestamp(text.cast("string"), F.lit("yyyyMMddHHmmss"))


def market_time(utc: Column, zone: str = NEW_YORK) -> Column:
    return F.from_utc_timestamp(utc, zone)


def trading_date(local: Column, open_hour: int = 9) -> Column:
    """Same day before the opening hour, next calendar day from then on. No weekend roll."""
    day = F.to_date(local)
    return F.when(F.hour(local) < open_hour, day).otherwise(F.date_add(day, 1))


def from_epoch_ms(value: Column) -> Column:
    """Milliseconds since the epoch, cut to whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(value))


def from_epoch_us(value: Column) -> Column:
    return F.timestamp_micros(value)


def bucket_start(ts: Column, width: str) -> Column:
    """Start of the bucket: a unit such as ``minute`` or ``day``, or an interval such as ``15 minutes``."""
    if " " in width:
        return F.window(ts, width).getField("start")
    return F.date_trunc(width, ts)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")
