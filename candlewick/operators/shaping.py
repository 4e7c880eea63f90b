"""Small projections shared by the jobs."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions.numeric import all_of, recode
from candlewick.schemas import STAMP

log = logging.getLogger(__name__)


def bar_projection(df: DataFrame) -> DataFrame:
    return df.select(F.to_date("date").alias("date"), "open", "high", "low", "close", "volume", "ticker")


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(STAMP, F.current_timestamp())


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns, ignoring case and names that are not there."""
    unwanted = {c.lower() for c in columns}
    return df.select(*[c for c in df.columns if c.lower() not in unwanted])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def available(df: DataFrame, wanted: Sequence[str], always: Sequence[str] = ()) -> DataFrame:
    """The wanted columns that exist, in the wanted order; a warning names the others."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        log.warning("missing columns: %s", ", ".join(missing))
    return df.select(*always, *[c for c in wanted if c in df.columns])


def recode_column(df: DataFrame, column: str, mapping: Mapping[str, str], name: str | None = None) -> DataFrame:
    return df.withColumn(name or column, recode(F.col(column), dict(mapping)))


def fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL and NaN in the named columns."""
    return df.na.fill(dict(defaults))


def blank_strings(df: DataFrame) -> DataFrame:
    """NULL strings become empty strings, in every string column."""
    return df.na.fill("")


def where_all(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    return df.filter(all_of(list(conditions)))


def not_deleted(df: DataFrame, equal: Mapping[str, object] | None = None, status: str = "status") -> DataFrame:
    """Rows that are not soft-deleted and equal every given value; ``None`` values are no filter."""
    wanted = [F.col(c) == F.lit(v) for c, v in (equal or {}).items() if v is not None]
    return where_all(df, [F.col(status) != "deleted", *wanted])


def features_with_sentiment(
    indicators: DataFrame, sentiment: DataFrame, names: Mapping[str, str] | None = None
) -> DataFrame:
    """Indicators left-joined with daily sentiment; days without news get 0.0.

    ``names`` maps company names back to tickers on the sentiment side.
    """
    daily = recode_column(sentiment, "ticker", names or {}).select("date", "ticker", "sentiment_sum", "polarity_ratio")
    return fill(indicators.join(daily, ["date", "ticker"], "left"), {"sentiment_sum": 0.0, "polarity_ratio": 0.0})


def bars_with_indicators(bars: DataFrame, indicators: DataFrame) -> DataFrame:
    """Bars left-joined with indicators kept in another table."""
    return bars.join(indicators, ["date", "ticker"], "left")


def with_active_version(base: DataFrame, versions: DataFrame, key: str) -> DataFrame:
    """Rows that have an active version, with that version's columns."""
    return base.join(versions.filter(F.col("is_active")).drop("is_active"), key)
