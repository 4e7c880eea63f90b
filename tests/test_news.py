"""Titles, times, rules, sentiment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.functions.numeric import label_score, ratio, recode, safe_log
from candlewick.functions.text import headline, strip, tag_title, title_case, url_title
from candlewick.functions.timefn import bucket_start, compact_timestamp, from_epoch_ms, market_time, trading_date
from candlewick.operators import sentiment as sm
from candlewick.operators.rules import any_rule, match_rules, rules_from_frame
from candlewick.plans import jobs


def _one(spark, column, **values):
    """Value of a Column over one row of strings."""
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "title"),
    [
        ("a <PAGE_TITLE> Hello there\t</PAGE_TITLE> b", "Hello there"),
        ("<PAGE_TITLE>one</PAGE_TITLE><PAGE_TITLE>two</PAGE_TITLE>", "one"),
        ("<PAGE_TITLE></PAGE_TITLE>", ""),
        ("<PAGE_TITLE>no end", None),
        ("<PAGE_TITLE>two\nlines</PAGE_TITLE>", None),
        ("nothing", None),
        (None, None),
    ],
)
def test_tag_title(spark, text, title):
    assert _one(spark, tag_title(F.col("t")), t=text) == title


@pytest.mark.parametrize(
    ("url", "title"),
    [
        ("https://a.com/news/big-tech_rises+today-2024.html", "Big Tech Rises Today .Html"),
        ("https://a.com/some-story/", "Some Story"),
        ("https://a.com/some-story?q=1", "Some Story?Q="),
        ("https://a.com/12345", ""),
        ("https://a.com/o'neil-3rd-win", "O'Neil Rd Win"),
        ("///", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_url_title(spark, url, title):
    assert _one(spark, url_title(F.col("u")), u=url) == title


@pytest.mark.parametrize("text", ["they're bill's", "x1y2 éa ÀB", "straße", "foo.html?q=1", "", "ÉTÉ à l'eau"])
def test_title_case_is_python_title(spark, text):
    assert _one(spark, title_case(F.col("t")), t=text) == text.title()


@pytest.mark.parametrize("text", [" \t\n a b  ", "\x1cx\x1f", "", "  "])
def test_strip_is_python_strip(spark, text):
    assert _one(spark, strip(F.col("t")), t=text) == text.strip()


def test_empty_tag_blocks_the_url_title(spark):
    title = headline(F.col("t"), F.col("u"))
    assert _one(spark, title, t="<PAGE_TITLE> </PAGE_TITLE>", u="https://a.com/long-enough-title") == ""
    assert _one(spark, title, t="none", u="https://a.com/long-enough-title") == "Long Enough Title"


@pytest.mark.parametrize(
    ("utc", "local_hour", "day"),
    [
        ("2024-01-10 13:59:00", 8, dt.date(2024, 1, 10)),
        ("2024-01-10 14:00:00", 9, dt.date(2024, 1, 11)),
        ("2024-07-10 12:59:00", 8, dt.date(2024, 7, 10)),
        ("2024-07-10 13:00:00", 9, dt.date(2024, 7, 11)),
        ("2024-01-13 20:00:00", 15, dt.date(2024, 1, 14)),  # no weekend roll
        ("2024-01-01 03:00:00", 22, dt.date(2024, 1, 1)),
    ],
)
def test_trading_date(spark, utc, local_hour, day):
    local = market_time(F.col("t").cast("timestamp"))
    assert _one(spark, F.hour(local), t=utc) == local_hour
    assert _one(spark, trading_date(local), t=utc) == day


def test_time_parsing(spark):
    assert _one(spark, compact_timestamp(F.col("t")).cast("string"), t="20240131235959") == "2024-01-31 23:59:59"
    assert _one(spark, compact_timestamp(F.col("t")), t="2024-01-31") is None
    assert _one(spark, compact_timestamp(F.col("t")), t=None) is None
    assert _one(spark, from_epoch_ms(F.col("t").cast("long")).cast("string"), t="1704067200999") == "2024-01-01 00:00:00"
    at = F.col("t").cast("timestamp")
    assert _one(spark, bucket_start(at, "15 minutes").cast("string"), t="2024-01-01 10:29:59") == "2024-01-01 10:15:00"
    assert _one(spark, bucket_start(at, "month").cast("string"), t="2024-05-09 10:00:00") == "2024-05-01 00:00:00"


def test_arithmetic_never_raises(spark):
    row = spark.range(1).select(
        ratio(F.lit(1.0), F.lit(0.0)).alias("r"), safe_log(F.lit(0.0)).alias("l"), safe_log(F.lit(-1.0)).alias("m")
    ).first()
    assert (row.r, row.l, row.m) == (None, None, None)


def test_label_score_and_recode(spark):
    assert _one(spark, label_score(F.col("t")), t=" Positive ") == 1.0
    assert _one(spark, label_score(F.col("t")), t="mixed") == 0.0
    assert _one(spark, label_score(F.col("t")), t=None) == 0.0
    assert _one(spark, recode(F.col("t"), {"NVDA": "Nvidia"}), t="NVDA") == "Nvidia"
    assert _one(spark, recode(F.col("t"), {"NVDA": "Nvidia"}), t="OTHER") == "OTHER"
    assert _one(spark, recode(F.col("t"), {"NVDA": "Nvidia"}), t=None) is None


RULES = {
    "NVDA": {"aliases": ["nvidia", "jensen huang", "rtx"], "blacklist": []},
    "MSFT": {"aliases": ["microsoft", "c++ (ms)"], "blacklist": ["soccer"]},
}


def _matches(spark, rows, **options):
    df = spark.createDataFrame(rows, "extracted_title string, source_url string")
    return {(r.extracted_title, r.ticker) for r in match_rules(df, RULES, **options).collect()}


def test_rules(spark):
    rows = [
        ("Nvidia and MICROSOFT agree", "u"),
        ("Jensen Huang speaks", "u"),
        ("Microsoft wins", "http://x/soccer"),
        ("Microsoft soccer", "u"),
        ("Using C++ (MS) today", None),
        ("the cartxyz", "u"),
        ("nothing", "u"),
    ]
    assert _matches(spark, rows) == {
        ("Nvidia and MICROSOFT agree", "NVDA"),
        ("Nvidia and MICROSOFT agree", "MSFT"),
        ("Jensen Huang speaks", "NVDA"),
        ("Using C++ (MS) today", "MSFT"),
        ("the cartxyz", "NVDA"),
    }
    assert ("the cartxyz", "NVDA") not in _matches(spark, rows, whole_word=True)


def test_rules_on_one_text(spark):
    df = spark.createDataFrame([("nvidia-soccer",), ("microsoft-soccer",), ("x",)], "u string")
    assert [r.u for r in df.filter(any_rule(RULES, F.col("u"))).collect()] == ["nvidia-soccer"]


def test_rules_need_content(spark):
    with pytest.raises(ValueError):
        match_rules(spark.range(1), {})
    frame = spark.createDataFrame([("A", ["a"], None), ("B", ["b"], ["x"])], "ticker string, aliases array<string>, blacklist array<string>")
    assert rules_from_frame(frame)["A"] == {"aliases": ["a"], "blacklist": []}
    with pytest.raises(ValueError):
        rules_from_frame(frame, most=1)


def test_silver_news(spark):
    noon = dt.datetime(2024, 1, 10, 12, 0)
    rows = [
        (noon, "https://a.com/nvidia-beats-estimates", "", "", "", "none"),
        (noon - dt.timedelta(hours=1), "https://b.com/x", "", "", "", "<PAGE_TITLE>Nvidia Beats Estimates</PAGE_TITLE>"),
        (noon, "https://a.com/nvidia-soa", "", "", "", ""),
        (noon, "https://a.com/nvidia-soar", "", "", "", ""),
        (None, "https://a.com/nvidia-without-time", "", "", "", ""),
    ]
    raw = spark.createDataFrame(rows, "date timestamp, source_url string, themes string, organizations string, tone string, extras string")
    out = {r.extracted_title: r for r in jobs.silver_news(raw, jobs.Settings(rules=RULES)).collect()}
    assert set(out) == {"Nvidia Beats Estimates", "Nvidia Soar"}  # ten characters are too few, eleven are enough
    first = out["Nvidia Beats Estimates"]
    assert first.source_url == "https://b.com/x" and first.date == dt.date(2024, 1, 10)


SCORED = "date date, ticker string, sentiment_label string, sentiment_score double"
DAY = dt.date(2024, 1, 2)


def test_daily_sentiment(spark):
    rows = [
        (DAY, "a", "positive", 1.0),
        (DAY, "a", "negative", -1.0),
        (DAY, "a", "neutral", 0.0),
        (DAY, "a", "odd", 0.0),
        (DAY, "b", "negative", -1.0),
        (DAY, "c", "odd", 0.0),
        (None, "a", "positive", 1.0),
        (DAY, None, "positive", 1.0),
    ]
    out = {r.ticker: r for r in sm.daily_sentiment(spark.createDataFrame(rows, SCORED), extended=True).collect()}
    assert set(out) == {"a", "b", "c"}
    assert out["a"].polarity_ratio == pytest.approx(1 / 3) and out["a"].news_count == 4 and out["a"].sentiment_avg == 0.0
    assert (out["b"].sentiment_sum, out["b"].polarity_ratio) == (-1.0, 0.0)
    assert (out["c"].sentiment_sum, out["c"].polarity_ratio) == (0.0, 0.5)


def test_model_failures_turn_neutral(spark):
    def load():
        def score(texts, aspects):
            if any("bad" in t for t in texts):
                raise RuntimeError("no")
            return [" Positive " if a == "A" else "NEGATIVE" for a in aspects]

        return score

    rows = [("fine", "A"), ("bad one", "A"), ("fine too", "B")]
    df = spark.createDataFrame(rows, "extracted_title string, company_name string").coalesce(1)
    out = {r.extracted_title: (r.sentiment_label, r.sentiment_score) for r in sm.model_scored(df, load).collect()}
    assert out == {"fine": ("positive", 1.0), "bad one": ("neutral", 0.0), "fine too": ("negative", -1.0)}


def test_lexicon(spark):
    rows = [("Strong growth, no loss",), ("Weak quarter",), ("Plain",), ("headstrong",)]
    df = spark.createDataFrame(rows, "extracted_title string")
    labels = [r.sentiment_label for r in sm.lexicon_scored(df).collect()]
    assert labels == ["positive", "negative", "neutral", "neutral"]


def test_news_plan_has_no_python(spark):
    raw = spark.createDataFrame([], "date timestamp, source_url string, extras string")
    plan = jobs.silver_news(raw, jobs.Settings())._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "Join" not in plan
