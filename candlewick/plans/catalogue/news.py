"""Headlines, rule matches, trading dates and sentiment."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from candlewick.functions.numeric import label_score
from candlewick.functions.text import headline, prompt, tag_title, title_case, url_title
from candlewick.functions.timefn import compact_timestamp, market_time, trading_date
from candlewick.operators import sentiment as sm
from candlewick.operators.rules import match_many, match_rules
from candlewick.operators.shaping import features_with_sentiment, recode_column
from candlewick.operators.versions import keep_first
from candlewick.plans import inputs, jobs
from candlewick.plans.catalogue.registry import query, rounded, rounded_sql
from candlewick.session import shared_dir
from candlewick.sources.landing import landed_news, typed_news

# --- titles --------------------------------------------------------------------------------------------

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def _title_case_sql(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, '[{_CASED}]+|[^{_CASED}]+'), "
        f"lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])), '')"
    )


_TAG_SQL = "CASE WHEN regexp_matches(html, '<title>(.*?)</title>') THEN trim(regexp_extract(html, '<title>(.*?)</title>', 1)) END"
_SLUG_SQL = r"regexp_extract(trim(url, '/'), '([^/]+)(?:\.html|\?|$)', 1)"
_URL_SQL = _title_case_sql(rf"trim(translate(regexp_replace({_SLUG_SQL}, '\p{{Nd}}+', '', 'g'), '-_+', '   '))")


@query("tag_titles", f"SELECT page_id, {_TAG_SQL} AS title FROM pages")
def tag_titles(spark, d):
    return inputs.table(spark, d, "pages").select("page_id", tag_title(F.col("html"), "title").alias("title"))


@query("url_titles", f"SELECT page_id, coalesce({_URL_SQL}, '') AS title FROM pages")
def url_titles(spark, d):
    return inputs.table(spark, d, "pages").select("page_id", url_title(F.col("url")).alias("title"))


@query(
    "headlines",
    f"""WITH t AS (SELECT page_id, coalesce({_TAG_SQL}, {_URL_SQL}, '') AS extracted_title FROM pages)
SELECT * FROM t WHERE length(extracted_title) > 10""",
)
def headlines(spark, d):
    titled = inputs.table(spark, d, "pages").select(
        "page_id", headline(F.col("html"), F.col("url"), "title").alias("extracted_title")
    )
    return titled.filter(F.length("extracted_title") > 10)


@query("title_case", f"SELECT doc_id, {_title_case_sql('text')} AS title FROM documents")
def title_cased(spark, d):
    return inputs.table(spark, d, "documents").select("doc_id", title_case(F.col("text")).alias("title"))


@query(
    "prompts",
    "SELECT doc_id, 'Rate: ' || text || ' The aspect is ' || source || chr(10) || 'output:' AS prompt FROM documents",
)
def prompts(spark, d):
    docs = inputs.table(spark, d, "documents")
    text = prompt(F.col("text"), F.col("source"), "Rate: ", sm.ASPECT_DELIMITER, "\noutput:")
    return docs.select("doc_id", text.alias("prompt"))


# --- times ---------------------------------------------------------------------------------------------


@query("trading_dates", f"WITH {inputs.NEWS} SELECT doc_id, timestamp_et, date FROM dated_news")
def trading_dates(spark, d):
    local = inputs.news(spark, d).withColumn("timestamp_et", market_time(F.col("timestamp_utc")))
    return local.select("doc_id", "timestamp_et", trading_date(F.col("timestamp_et")).alias("date"))


@query(
    "compact_timestamps",
    """WITH t AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'x' || strftime(ts, '%Y%m%d%H%M%S')
                              ELSE strftime(ts, '%Y%m%d%H%M%S') END AS compact FROM events)
SELECT event_id, try_strptime(compact, '%Y%m%d%H%M%S') AS timestamp FROM t""",
)
def compact_timestamps(spark, d):
    """Compact times, broken for one kind of event."""
    text = F.date_format("ts", "yyyyMMddHHmmss")
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), text)).otherwise(text)
    return inputs.table(spark, d, "events").select("event_id", compact_timestamp(broken).alias("timestamp"))


# --- rules ---------------------------------------------------------------------------------------------


def hit_sql(text: str, words: list[str]) -> str:
    return " OR ".join(f"contains(lower({text}), '{w.lower()}')" for w in words) or "false"


def _match_sql(source: str, columns: str, title: str = "extracted_title", url: str = "source_url") -> str:
    """One filtered scan per rule, united."""
    parts = []
    for ticker, rule in inputs.SAMPLE_RULES.items():
        banned = hit_sql(title, rule["blacklist"]) + " OR " + hit_sql(url, rule["blacklist"])
        parts.append(
            f"SELECT {columns}, '{ticker}' AS ticker FROM {source} WHERE ({hit_sql(title, rule['aliases'])}) AND NOT ({banned})"
        )
    return " UNION ALL ".join(parts)


@query("rule_matches", f"WITH {inputs.NEWS} {_match_sql('news', 'doc_id')}")
def rule_matches(spark, d):
    return match_rules(inputs.news(spark, d), inputs.SAMPLE_RULES).select("doc_id", "ticker")


_WHOLE = {"THE": {"aliases": ["the", "tion"], "blacklist": ["und"]}, "LA": {"aliases": ["la"], "blacklist": []}}


@query(
    "rule_matches_whole_word",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS words FROM documents)
SELECT doc_id, 'THE' AS ticker FROM w WHERE list_has_any(words, ['the', 'tion']) AND NOT list_contains(words, 'und')
UNION ALL SELECT doc_id, 'LA' FROM w WHERE list_contains(words, 'la')""",
)
def rule_matches_whole_word(spark, d):
    return match_rules(inputs.news(spark, d), _WHOLE, whole_word=True).select("doc_id", "ticker")


@query(
    "rule_matches_many",
    f"""WITH {inputs.NEWS}, t AS MATERIALIZED (SELECT doc_id, lower(extracted_title) AS title, lower(source_url) AS url FROM news),
r AS MATERIALIZED (SELECT 'D' || doc_id AS ticker, lower(substr(text, 11, 14)) AS a, lower(substr(text, 41, 2)) || '¬' AS b, lower(substr(text, 71, 9)) AS c,
  CASE WHEN doc_id % 2 = 0 THEN lower(substr(text, 101, 6)) END AS banned FROM documents WHERE length(text) >= 120)
SELECT doc_id, ticker FROM t JOIN r ON (contains(title, a) OR contains(title, b) OR contains(title, c))
WHERE banned IS NULL OR NOT (contains(title, banned) OR contains(url, banned))""",
)
def rule_matches_many(spark, d):
    """A rule for each document, from stretches of its text: as many rules as headlines."""
    docs = inputs.table(spark, d, "documents").filter(F.length("text") >= 120)
    aliases = F.array(F.substring("text", 11, 14), F.concat(F.substring("text", 41, 2), F.lit("¬")), F.substring("text", 71, 9))
    banned = F.when(F.col("doc_id") % 2 == 0, F.array(F.substring("text", 101, 6)))
    rules = docs.select(F.concat(F.lit("D"), "doc_id").alias("ticker"), aliases.alias("aliases"), banned.alias("blacklist"))
    return match_many(inputs.news(spark, d), rules).select("doc_id", "ticker")


@query(
    "silver_news",
    f"""WITH raw AS (SELECT page_id, html, url, TIMESTAMP '{inputs.START} 00:00:00' + to_minutes(page_id * 37) AS utc FROM pages),
t AS (SELECT coalesce({_TAG_SQL}, {_URL_SQL}, '') AS extracted_title, url AS source_url,
      timezone('America/New_York', timezone('UTC', utc)) AS timestamp_et FROM raw),
dated AS (SELECT *, CASE WHEN hour(timestamp_et) < 9 THEN CAST(timestamp_et AS DATE) ELSE CAST(timestamp_et AS DATE) + 1 END
          AS date FROM t WHERE length(extracted_title) > 10),
matched AS ({_match_sql('dated', '*')})
SELECT date, ticker, extracted_title, source_url, timestamp_et FROM matched
QUALIFY row_number() OVER (PARTITION BY date, ticker, extracted_title ORDER BY timestamp_et, source_url) = 1""",
)
def silver_news(spark, d):
    """The whole path from raw pages to matched titles."""
    at = F.lit(inputs.START).cast("timestamp") + F.make_dt_interval(mins=F.col("page_id").cast("int") * 37)
    raw = inputs.table(spark, d, "pages").select(
        F.col("html").alias("extras"), F.col("url").alias("source_url"), at.alias("date")
    )
    return jobs.silver_news(raw, jobs.Settings(rules=inputs.SAMPLE_RULES, tag="title"))


_URL_RULES = {"SPAM": {"aliases": ["spam-farm", "cheap"], "blacklist": ["utm_source"]}, "LOCAL": {"aliases": ["/en/", "/fr/"], "blacklist": []}}


@query(
    "news_landing",
    f"""WITH raw AS (SELECT page_id, url, html,
    CAST(TIMESTAMP '{inputs.START} 00:00:00' + to_minutes(page_id * 37) AS DATE) AS day FROM pages)
SELECT TIMESTAMP '{inputs.START} 00:00:00' + to_minutes(page_id * 37) AS date, url AS source_url, '' AS themes,
       CASE WHEN url LIKE 'https:%' THEN 'org' ELSE '' END AS organizations, '' AS tone, html AS extras FROM raw
WHERE day BETWEEN DATE '2024-01-02' AND DATE '2024-03-01'
  AND url NOT LIKE '%/fr/%'
  AND ((regexp_matches(lower(url), 'spam-farm|cheap') AND NOT regexp_matches(lower(url), 'utm_source'))
       OR regexp_matches(lower(url), '/en/|/fr/'))""",
)
def news_landing(spark, d):
    """Pages landed by day, the French ones translated, then read back by date range and URL rules."""
    at = F.lit(inputs.START).cast("timestamp") + F.make_dt_interval(mins=F.col("page_id").cast("int") * 37)
    path = shared_dir(spark, "news")
    inputs.table(spark, d, "pages").select(
        F.date_format(at, "yyyyMMddHHmmss").alias("DATE"),
        F.col("url").alias("DocumentIdentifier"),
        F.lit(None).cast("string").alias("Themes"),
        F.when(F.col("url").startswith("https:"), "org").alias("Organizations"),
        F.lit("").alias("V2Tone"),
        F.col("html").alias("Extras"),
        F.when(F.col("url").contains("/fr/"), "srclc:fra").otherwise("").alias("TranslationInfo"),
        F.to_date(at).alias("_PARTITIONDATE"),
    ).write.partitionBy("_PARTITIONDATE").parquet(path)
    return typed_news(landed_news(spark.read.parquet(path), _URL_RULES, "2024-01-02", "2024-03-01"))


@query(
    "first_of_duplicates",
    """SELECT * FROM (SELECT doc_id, text, lang, source FROM documents)
QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id, source) = 1""",
)
def first_of_duplicates(spark, d):
    docs = inputs.table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    return keep_first(docs, ["text", "lang"], ["doc_id", "source"])


# --- sentiment -------------------------------------------------------------------------------------------


def _count_sql(words: list[str]) -> str:
    wanted = ", ".join(f"'{w}'" for w in words)
    return rf"len(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda w: w IN ({wanted})))"


_BALANCE = f"({_count_sql(inputs.SAMPLE_POSITIVE)} - {_count_sql(inputs.SAMPLE_NEGATIVE)})"
LEXICON_CASE = f"CASE WHEN {_BALANCE} > 0 THEN 'positive' WHEN {_BALANCE} < 0 THEN 'negative' ELSE 'neutral' END"
_LEXICON_SQL = f"""SELECT doc_id, {LEXICON_CASE} AS sentiment_label, CAST(sign({_BALANCE}) AS DOUBLE) AS sentiment_score
FROM documents"""


@query("lexicon_scores", _LEXICON_SQL)
def lexicon_scores(spark, d):
    out = sm.lexicon_scored(inputs.news(spark, d), "extracted_title", inputs.SAMPLE_POSITIVE, inputs.SAMPLE_NEGATIVE)
    return out.select("doc_id", "sentiment_label", "sentiment_score")


def _load_word_scorer():
    """A model stand-in with the lexicon's result; a real one would load weights here, once per task."""
    up, down = (
        re.compile(rf"\b(?:{'|'.join(words)})\b") for words in (inputs.SAMPLE_POSITIVE, inputs.SAMPLE_NEGATIVE)
    )

    def score(texts: list[str], aspects: list[str]) -> list[str]:
        labels = []
        for text in texts:
            balance = len(up.findall(text.lower())) - len(down.findall(text.lower()))
            labels.append("positive" if balance > 0 else "negative" if balance < 0 else "neutral")
        return labels

    return score


@query("model_scores", _LEXICON_SQL)
def model_scores(spark, d):
    named = inputs.news(spark, d).select("doc_id", "extracted_title", F.col("lang").alias("company_name"))
    return sm.model_scored(named, _load_word_scorer).select("doc_id", "sentiment_label", "sentiment_score")


_DAILY_SQL = """SELECT date, ticker, sum(sentiment_score) AS sentiment_sum, {average},
  coalesce(count(*) FILTER (sentiment_label = 'positive') /
    nullif(count(*) FILTER (sentiment_label IN ('positive', 'negative', 'neutral')), 0), 0.5) AS polarity_ratio,
  count(sentiment_score) AS news_count FROM scored GROUP BY ALL"""


@query(
    "daily_sentiment",
    f"""WITH {inputs.SCORED}, x AS ({_DAILY_SQL.format(average="avg(sentiment_score) AS sentiment_avg")})
SELECT date, ticker, sentiment_sum, {rounded_sql("sentiment_avg")}, {rounded_sql("polarity_ratio")}, news_count FROM x""",
)
def daily_sentiment(spark, d):
    out = sm.daily_sentiment(inputs.scored(spark, d), extended=True)
    return out.select(
        "date", "ticker", "sentiment_sum", rounded("sentiment_avg"), rounded("polarity_ratio"), "news_count"
    )


@query(
    "label_counts",
    f"""WITH {inputs.SCORED} SELECT date, ticker, count(*) FILTER (sentiment_label = 'positive') AS positive,
  count(*) FILTER (sentiment_label = 'negative') AS negative, count(*) FILTER (sentiment_label = 'neutral') AS neutral
FROM scored GROUP BY ALL""",
)
def label_counts(spark, d):
    return sm.label_counts(inputs.scored(spark, d))


@query("label_distribution", f'WITH {inputs.SCORED} SELECT sentiment_label, count(*) AS "rows" FROM scored GROUP BY ALL')
def label_distribution(spark, d):
    return sm.label_distribution(inputs.scored(spark, d))


@query(
    "label_scores",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1.0::DOUBLE WHEN '5-LOW' THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END
  AS score FROM orders""",
)
def label_scores(spark, d):
    """Labels with blanks and capitals around them, scored by a table."""
    noisy = F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))
    score = label_score(noisy, {"1-urgent": 1.0, "5-low": -1.0})
    return inputs.table(spark, d, "orders").select("o_orderkey", score.alias("score"))


_NAMES = {"en": "English", "fr": "French"}
_LANG_CASE = "CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE lang END"


@query("recoded_names", f"SELECT doc_id, {_LANG_CASE} AS company_name FROM documents")
def recoded_names(spark, d):
    docs = inputs.table(spark, d, "documents").select("doc_id", "lang")
    return recode_column(docs, "lang", _NAMES, "company_name").select("doc_id", "company_name")


_BY_YEAR = {"1-URGENT": "en", "2-HIGH": "fr", "3-MEDIUM": "de", "4-NOT SPECIFIED": "es"}


@query(
    "features_with_sentiment",
    f"""WITH {inputs.FEATURES}, {inputs.SCORED},
daily AS (SELECT x.*, date - INTERVAL '27 years' AS d27 FROM ({_DAILY_SQL.format(average="0 AS unused")}) x),
named AS (SELECT CAST(d27 AS DATE) AS date, CASE ticker WHEN 'en' THEN '1-URGENT' WHEN 'fr' THEN '2-HIGH' WHEN 'de' THEN '3-MEDIUM'
  WHEN 'es' THEN '4-NOT SPECIFIED' ELSE ticker END AS ticker, sentiment_sum, polarity_ratio FROM daily)
SELECT f.ticker, f.date, {rounded_sql("MA_20", 4)}, coalesce(sentiment_sum, 0.0) AS sentiment_sum,
  {rounded_sql("coalesce(polarity_ratio, 0.0)", 6, "polarity_ratio")}
FROM features f LEFT JOIN named n ON f.date = n.date AND f.ticker = n.ticker""",
)
def with_sentiment(spark, d):
    """Daily features with the sentiment of the language that stands for the ticker, 27 years apart."""
    daily = sm.daily_sentiment(inputs.scored(spark, d))
    shifted = daily.withColumn("date", F.add_months("date", -27 * 12))
    back = {name: ticker for ticker, name in _BY_YEAR.items()}
    out = features_with_sentiment(inputs.features(spark, d), shifted, back)
    return out.select("ticker", "date", rounded("MA_20", 4), "sentiment_sum", rounded("polarity_ratio"))
