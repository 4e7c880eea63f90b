"""Landed raw files to typed rows: bars, news, quotes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.functions.numeric import is_blank
from candlewick.functions.timefn import compact_timestamp
from candlewick.operators.rules import Rules, any_rule
from candlewick.operators.shaping import blank_strings, lower_names
from candlewick.schemas import BARS, NEWS_RAW, QUOTE_COLUMNS, QUOTE_PAYLOAD


def landed_bars(
    spark: SparkSession,
    path: str,
    tickers: Sequence[str] | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Bars landed as CSV with header, one folder ``ticker=<t>`` per ticker.

    Ticker and date filters prune folders and rows; a ticker without files simply adds no rows.
    """
    # Columns go by header name, in any order and case; a file whose header differs from the others' is an error.
    reader = spark.read.option("header", True)
    types = {f.name.lower(): f.dataType.simpleString() for f in BARS.fields}
    found = [c for c in reader.csv(path).columns if c.lower() != "ticker"]
    columns = ", ".join(f"`{c}` {types.get(c.lower(), 'string')}" for c in found)
    df = lower_names(reader.option("enforceSchema", False).schema(f"{columns}, ticker string").csv(path))
    if tickers is not None:
        df = df.filter(F.col("ticker").isin(*tickers))
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df.select(*BARS.fieldNames())


def landed_news(
    df: DataFrame, rules: Rules, start: date | str | None = None, end: date | str | None = None, partition: str = "_PARTITIONDATE"
) -> DataFrame:
    """News, of a closed date range if bounds are given, untranslated, whose URL satisfies a rule; six text fields, NULL as ''.

    The date range is on the partition column, so other partitions are never listed or read.
    """
    if start is not None:
        df = df.filter(F.col(partition) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(partition) <= F.lit(end).cast("date"))
    kept = df.filter(is_blank(F.col("TranslationInfo")) & any_rule(rules, F.col("DocumentIdentifier")))
    out = kept.select(
        F.col("DATE").alias("date"),
        F.col("DocumentIdentifier").alias("source_url"),
        F.col("Themes").alias("themes"),
        F.col("Organizations").alias("organizations"),
        F.col("V2Tone").alias("tone"),
        F.col("Extras").alias("extras"),
    )
    return blank_strings(out)


def typed_news(df: DataFrame) -> DataFrame:
    """Landed news with the compact date text as a timestamp."""
    typed = df.withColumn("date", compact_timestamp(F.col("date")))
    return typed.select(*[F.col(f.name).cast(f.dataType) for f in NEWS_RAW.fields])


def quotes(
    df: DataFrame, payload: str = "payload", symbol: str = "symbol", now: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """JSON quotes to typed rows; quotes without a price, or with price 0, are dropped. ``keep`` names further columns to carry along.

    Works on batch and streaming frames. A quote without a time gets ``now`` (default: the current time).
    """
    q = F.from_json(F.col(payload), QUOTE_PAYLOAD).alias("_q")
    parsed = df.select(F.col(symbol).alias("symbol"), *keep, q).filter(F.col("_q.c").isNotNull() & (F.col("_q.c") != 0))
    taken = F.timestamp_seconds(F.col("_q.t").cast("long"))
    return parsed.select(
        "symbol",
        *[F.col(f"_q.{key}").alias(name) for key, name in QUOTE_COLUMNS.items()],
        F.coalesce(taken, F.current_timestamp() if now is None else now).alias("timestamp"),
        *keep,
    )
