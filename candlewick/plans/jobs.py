"""Batch jobs between the layers. Each returns the target table's row count."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.text import headline
from candlewick.functions.timefn import market_time, trading_date
from candlewick.operators.indicators import forward_label, indicator_set
from candlewick.operators.rules import Rules, match_rules
from candlewick.operators.sentiment import daily_sentiment, lexicon_scored
from candlewick.operators.shaping import bar_projection, drop_if_present, features_with_sentiment, recode_column, stamped
from candlewick.operators.versions import keep_first
from candlewick.schemas import COMPANY_NAMES, DEFAULT_RULES, STAMP
from candlewick.session import staged
from candlewick.sinks.layers import LAYERS, Lake, valid_name
from candlewick.sources.tables import Connection, ReadSplit, read_csv, read_jdbc


@dataclass(frozen=True)
class Tables:
    """Names of the stored tables."""

    bars: str = "bronze.bars"
    news_raw: str = "bronze.news_raw"
    indicators: str = "silver.stock_indicators"
    news: str = "silver.news"
    gold_bars: str = "gold.bars"
    sentiment: str = "gold.sentiment_features"
    scored: str = "gold.scored_news"
    features: str = "gold.ml_features"


@dataclass(frozen=True)
class Settings:
    """What the jobs need to know besides the data.

    ``partition_by`` is the layout of new tables; ``("date",)`` suits large ones, since an upsert then rewrites only
    the days it touches.
    """

    tables: Tables = Tables()
    rules: Rules = field(default_factory=lambda: DEFAULT_RULES)
    names: Mapping[str, str] = field(default_factory=lambda: COMPANY_NAMES)
    score: Callable[[DataFrame], DataFrame] = lexicon_scored
    tag: str = "PAGE_TITLE"
    partition_by: tuple[str, ...] = ()


def ingest(
    lake: Lake,
    df: DataFrame | None,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    layout_from_keys: bool = False,
) -> int:
    """Stamp and upsert rows, and return the row count; without any rows nothing is written."""
    if df is None:
        return 0
    lake.recover(table)
    lake.upsert(stamped(df), table, keys, partition_by, True, layout_from_keys)
    return lake.count(table) if lake.exists(table) else 0


def land_bars(lake: Lake, bars: DataFrame | None, settings: Settings = Settings()) -> int:
    return ingest(lake, bars, settings.tables.bars, ["date", "ticker"], settings.partition_by)


def land_news(lake: Lake, news: DataFrame | None, settings: Settings = Settings()) -> int:
    """News times are instants, so a dated layout goes by their day. Of repeated rows of one time and URL the first by content lands."""
    if news is not None:
        keys = ["date", "source_url"]
        news = keep_first(news, keys, [c for c in news.columns if c not in keys])
    if news is None or not settings.partition_by:
        return ingest(lake, news, settings.tables.news_raw, ["date", "source_url"])
    daily = news.withColumn("day", F.to_date("date"))
    return ingest(lake, daily, settings.tables.news_raw, ["date", "source_url"], ["day"], layout_from_keys=True)


# --- the work of each job as a plain frame -------------------------------------------------------------


def silver_news(raw: DataFrame, settings: Settings) -> DataFrame:
    """Titles over ten characters, on their trading date, matched to tickers, one row per date, ticker and title."""
    titled = raw.select(
        headline(F.col("extras"), F.col("source_url"), settings.tag).alias("extracted_title"),
        "source_url",
        market_time(F.col("date")).alias("timestamp_et"),
    ).filter((F.length("extracted_title") > 10) & F.col("timestamp_et").isNotNull())
    dated = titled.withColumn("date", trading_date(F.col("timestamp_et")))
    matched = match_rules(dated, settings.rules).select("date", "ticker", "extracted_title", "source_url", "timestamp_et")
    return keep_first(matched, ["date", "ticker", "extracted_title"], ["timestamp_et", "source_url"])


TITLE = ["date", "ticker", "extracted_title"]


def scored_titles(news: DataFrame, settings: Settings) -> DataFrame:
    """Headlines with label and score."""
    named = recode_column(news.select(*TITLE), "ticker", settings.names, "company_name")
    return settings.score(named)


def gold_sentiment(news: DataFrame, settings: Settings) -> DataFrame:
    """Scored headlines rolled up per date and ticker."""
    return daily_sentiment(scored_titles(news, settings))


def gold_features(indicators: DataFrame, sentiment: DataFrame, settings: Settings) -> DataFrame:
    """Indicators with sentiment and the next day's return as label."""
    back = {name: ticker for ticker, name in settings.names.items()}
    joined = features_with_sentiment(drop_if_present(indicators, [STAMP]), sentiment, back)
    return forward_label(joined)


# --- jobs -------------------------------------------------------------------------------------------


def _merge_daily(lake: Lake, df: DataFrame, table: str, settings: Settings) -> int:
    return lake.write(stamped(df), table, "merge", ["date", "ticker"], settings.partition_by)


def bars_to_indicators(lake: Lake, settings: Settings = Settings(), tickers: Sequence[str] | None = None) -> int:
    """All tickers in one pass."""
    bars = bar_projection(lake.read(settings.tables.bars))
    if tickers is not None:
        bars = bars.filter(F.col("ticker").isin(*tickers))
    return _merge_daily(lake, indicator_set(bars), settings.tables.indicators, settings)


def news_to_titles(lake: Lake, settings: Settings = Settings()) -> int:
    raw = lake.read(settings.tables.news_raw)
    titles = silver_news(raw, settings)
    return ingest(lake, titles, settings.tables.news, ["date", "ticker", "extracted_title"], settings.partition_by)


def bars_to_gold(lake: Lake, settings: Settings = Settings()) -> int:
    bars = bar_projection(lake.read(settings.tables.bars))
    return _merge_daily(lake, bars, settings.tables.gold_bars, settings)


def unscored(news: DataFrame, ledger: DataFrame) -> DataFrame:
    """Headlines that the ledger does not hold. NULLs compare as equal."""
    known = ledger.select(F.struct(*TITLE).alias("_title")).distinct()
    return news.select("*", F.struct(*TITLE).alias("_title")).join(known, "_title", "left_anti").drop("_title")


def news_to_sentiment(lake: Lake, settings: Settings = Settings()) -> int:
    """Score the headlines that no run before has scored, and roll up the days they belong to.

    The ledger of scored headlines is written last: a run that fails before scores the same headlines again, and its
    upsert of the days changes nothing then. So a score is paid for once, and no headline is left out of its day.
    """
    tables = settings.tables
    news = lake.read(tables.news)
    lake.recover(tables.scored)
    ledger = lake.read(tables.scored) if lake.exists(tables.scored) else None
    fresh = news if ledger is None else unscored(news, ledger)
    scored = staged(scored_titles(fresh.select(*TITLE).distinct(), settings).select(*TITLE, "sentiment_label", "sentiment_score"), "scored")
    if scored.isEmpty():
        return lake.count(tables.sentiment) if lake.exists(tables.sentiment) else _merge_daily(lake, daily_sentiment(scored), tables.sentiment, settings)
    days = scored
    if ledger is not None:
        touched = scored.select("date", "ticker").distinct()
        days = scored.unionByName(ledger.select(*scored.columns).join(touched, ["date", "ticker"], "left_semi"))
    count = _merge_daily(lake, daily_sentiment(days), tables.sentiment, settings)
    lake.append(scored, tables.scored, settings.partition_by)
    return count


def build_features(lake: Lake, settings: Settings = Settings()) -> int:
    tables = settings.tables
    features = gold_features(lake.read(tables.indicators), lake.read(tables.sentiment), settings)
    return _merge_daily(lake, features, tables.features, settings)


def csv_to_layer(
    lake: Lake, path: str, table: str, layer: str = "bronze", keys: Sequence[str] = (), mode: str = "overwrite", schema=None
) -> int:
    df = stamped(read_csv(lake.spark, path, schema))
    return lake.write(df, f"{layer}.{valid_name(table)}", mode, keys)


@dataclass(frozen=True)
class SourceTable:
    """One database table to ingest."""

    schema: str
    table: str
    keys: tuple[str, ...] = ()
    split: ReadSplit | None = None

    def __post_init__(self):
        valid_name(self.schema)
        valid_name(self.table)


def jdbc_to_layer(lake: Lake, connection: Connection, tables: Sequence[SourceTable], layer: str = "bronze") -> dict[str, int]:
    """Ingest a list of database tables: upsert where keys are given, overwrite elsewhere."""
    if not tables:
        raise ValueError("at least one table is needed")
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    counts = {}
    for source in tables:
        df = read_jdbc(lake.spark, connection, f"{source.schema}.{source.table}", source.split)
        mode = "merge" if source.keys else "overwrite"
        counts[source.table] = lake.write(stamped(df), f"{layer}.{source.table}", mode, source.keys)
    return counts
