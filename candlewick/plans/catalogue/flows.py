"""Whole flows through the layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators.sentiment import lexicon_scored
from candlewick.plans import inputs, jobs, runner
from candlewick.plans.catalogue.news import LEXICON_CASE, hit_sql
from candlewick.plans.catalogue.registry import query, rounded, rounded_sql, scratch_lake
from candlewick.plans.catalogue.series import indicator_set_sql
from candlewick.schemas import PRICE_FEATURES

START = "1997-01-01"

# Documents stand in for the news of the years the orders cover; the rules name the order priorities.
RULES = {
    "1-URGENT": {"aliases": ["thatin", "inoran"], "blacklist": ["pills"]},
    "2-HIGH": {"aliases": ["orantion", "ononst"], "blacklist": ["eaux", "src3"]},
    "5-LOW": {"aliases": ["eaux"], "blacklist": []},
}


def _score(df):
    return lexicon_scored(df, "extracted_title", inputs.SAMPLE_POSITIVE, inputs.SAMPLE_NEGATIVE)


SETTINGS = jobs.Settings(rules=RULES, score=_score)


def _raw_news(spark, d):
    """One-line documents as tagged titles, one every 37 minutes."""
    at = F.lit(START).cast("timestamp") + F.make_dt_interval(mins=F.col("doc_id").cast("int") * 37)
    line = F.regexp_replace("text", r"\s+", " ")
    return inputs.table(spark, d, "documents").select(
        at.alias("date"),
        F.concat(F.lit("https://news.example.com/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("source_url"),
        *[F.lit("").alias(c) for c in ("themes", "organizations", "tone")],
        F.concat(F.lit("<PAGE_TITLE>"), line, F.lit("</PAGE_TITLE>")).alias("extras"),
    )


def _matched_sql() -> str:
    parts = []
    for ticker, rule in RULES.items():
        banned = f"{hit_sql('text', rule['blacklist'])} OR {hit_sql('source_url', rule['blacklist'])}"
        parts.append(f"SELECT *, '{ticker}' AS ticker FROM dated WHERE ({hit_sql('text', rule['aliases'])}) AND NOT ({banned})")
    return " UNION ALL ".join(parts)


_NEWS_SQL = f"""raw AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text,
    'https://news.example.com/' || source || '/' || doc_id AS source_url,
    timezone('America/New_York', timezone('UTC', TIMESTAMP '{START} 00:00:00' + to_minutes(doc_id * 37))) AS timestamp_et FROM documents),
dated AS (SELECT *, CASE WHEN hour(timestamp_et) < 9 THEN CAST(timestamp_et AS DATE) ELSE CAST(timestamp_et AS DATE) + 1 END AS date
    FROM raw WHERE length(text) > 10),
matched AS ({_matched_sql()}),
titles AS (SELECT * FROM matched QUALIFY row_number() OVER (PARTITION BY date, ticker, text ORDER BY timestamp_et, source_url) = 1),
labelled AS (SELECT date, ticker, {LEXICON_CASE} AS label FROM titles),
daily AS (SELECT date, ticker, CAST(count(*) FILTER (label = 'positive') - count(*) FILTER (label = 'negative') AS DOUBLE) AS sentiment_sum,
    count(*) FILTER (label = 'positive') / count(*) AS polarity_ratio FROM labelled GROUP BY ALL)"""


@query("sentiment_through_layers", f"WITH {_NEWS_SQL} SELECT date, ticker, sentiment_sum, {rounded_sql('polarity_ratio')} FROM daily")
def sentiment_through_layers(spark, d):
    """Raw news to titles to daily sentiment, each step stored in its layer."""
    lake = scratch_lake(spark)
    jobs.land_news(lake, _raw_news(spark, d), SETTINGS)
    jobs.news_to_titles(lake, SETTINGS)
    jobs.news_to_sentiment(lake, SETTINGS)
    stored = lake.read(SETTINGS.tables.sentiment)
    return stored.select("date", "ticker", "sentiment_sum", rounded("polarity_ratio"))


_COLUMNS = [*PRICE_FEATURES, "next_day_return"]


@query(
    "features_through_layers",
    indicator_set_sql(
        inputs.BARS + ", " + _NEWS_SQL,
        f"""SELECT i.ticker, i.date, {', '.join(rounded_sql(c, 4) for c in _COLUMNS)},
  coalesce(sentiment_sum, 0.0) AS sentiment_sum, {rounded_sql("coalesce(polarity_ratio, 0.0)", 6, "polarity_ratio")}
FROM (SELECT *, lead(Return) OVER (PARTITION BY ticker ORDER BY date) AS next_day_return FROM x) i
LEFT JOIN daily n ON n.date = i.date AND n.ticker = i.ticker""",
    ),
)
def features_through_layers(spark, d):
    """The full job sequence: bronze, silver, gold, then the stored feature table."""
    run = runner.Run(scratch_lake(spark), SETTINGS, bars=inputs.bars(spark, d), news=_raw_news(spark, d))
    results = runner.run_jobs(runner.SEQUENCES["full"], run)
    failed = [r["error"] for r in results.values() if not r["success"]]
    if failed:
        raise RuntimeError(failed[0])
    stored = run.lake.read(SETTINGS.tables.features)
    shown = [rounded(c, 4) for c in _COLUMNS]
    return stored.select("ticker", "date", *shown, "sentiment_sum", rounded("polarity_ratio"))
