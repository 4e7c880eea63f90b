"""Score headlines and roll them up per day and ticker."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions.numeric import label_score, ratio
from candlewick.functions.text import any_of_pattern
from candlewick.schemas import LABEL_SCORES

log = logging.getLogger(__name__)

# Model input wording.
INSTRUCTION = """Definition: Analyst task. Classify the sentiment of the financial Aspect as Positive, Negative, or Neutral.
Example 1:
input: Revenue grew significantly in the last quarter. The aspect is Revenue.
output: positive

input: """
ASPECT_DELIMITER = " The aspect is "
ENDING = " \noutput:"

# Small default word lists; pass your own for real use.
POSITIVE_WORDS = ["beats", "gain", "gains", "growth", "record", "rises", "soars", "strong", "surges", "upgrade"]
NEGATIVE_WORDS = ["cuts", "decline", "drops", "falls", "lawsuit", "loss", "misses", "plunges", "probe", "weak"]

Scorer = Callable[[list[str], list[str]], list[str]]


def word_count(text: Column, words: list[str]) -> Column:
    """Number of occurrences of whole words from the list."""
    return F.regexp_count(text, F.lit(any_of_pattern(words, whole_word=True)))


def lexicon_label(text: Column, positive: list[str] | None = None, negative: list[str] | None = None) -> Column:
    """Label by the balance of positive and negative words."""
    balance = word_count(text, positive or POSITIVE_WORDS) - word_count(text, negative or NEGATIVE_WORDS)
    return F.when(balance > 0, "positive").when(balance < 0, "negative").otherwise("neutral")


def lexicon_scored(
    df: DataFrame, text: str = "extracted_title", positive: list[str] | None = None, negative: list[str] | None = None
) -> DataFrame:
    labelled = df.withColumn("sentiment_label", lexicon_label(F.col(text), positive, negative))
    return labelled.withColumn("sentiment_score", label_score(F.col("sentiment_label")))


def model_scored(
    df: DataFrame,
    load: Callable[[], Scorer],
    text: str = "extracted_title",
    aspect: str = "company_name",
    batch: int = 100,
    tasks: int | None = None,
) -> DataFrame:
    """Label every row with a model.

    ``load`` runs once per task and returns a scorer from texts and aspects to labels. When a batch fails, its
    rows are tried one by one, and only those that fail again become neutral. Whole texts go in. ``tasks`` spreads the
    rows over that many tasks first: a slow model wants more of them than the scan has.
    """
    if tasks:
        df = df.repartition(tasks)
    schema = f"{df.schema.simpleString()[7:-1]},sentiment_label:string,sentiment_score:double"

    def one_by_one(score: Scorer, texts: list[str], aspects: list[str]) -> list[str]:
        labels = []
        for item, subject in zip(texts, aspects, strict=True):
            try:
                labels.append(score([item], [subject])[0])
            except Exception as problem:
                log.warning("scored as neutral: %s", problem)
                labels.append("neutral")
        return labels

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = load()
        for frame in frames:
            labels: list[str] = []
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                texts, aspects = part[text].tolist(), part[aspect].tolist()
                try:
                    found = list(score(texts, aspects))
                    if len(found) != len(texts):
                        raise ValueError("the scorer returned a wrong number of labels")
                except Exception:
                    found = one_by_one(score, texts, aspects)
                labels.extend(str(label).strip().lower() for label in found)
            scores = [LABEL_SCORES.get(label, 0.0) for label in labels]
            yield frame.assign(sentiment_label=labels, sentiment_score=scores)

    return df.mapInPandas(run, schema)


def daily_sentiment(scored: DataFrame, extended: bool = False) -> DataFrame:
    """Sum of scores and share of positive labels per date and ticker, in one aggregation.

    The share counts the three known labels only and is 0.5 when there are none. Rows without a date or ticker
    are left out.
    """
    label = F.col("sentiment_label")
    known = F.count_if(label.isin(*LABEL_SCORES))
    extra = [F.avg("sentiment_score").alias("sentiment_avg"), F.count("sentiment_score").alias("news_count")]
    return (
        scored.filter(F.col("date").isNotNull() & F.col("ticker").isNotNull())
        .groupBy("date", "ticker")
        .agg(
            F.coalesce(F.sum("sentiment_score"), F.lit(0.0)).alias("sentiment_sum"),
            F.coalesce(ratio(F.count_if(label == "positive"), known), F.lit(0.5)).alias("polarity_ratio"),
            *(extra if extended else []),
        )
    )


def label_counts(scored: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """One column per label with its count per date and ticker; 0 where a label is missing."""
    wanted = labels or list(LABEL_SCORES)
    return scored.groupBy("date", "ticker").agg(
        *[F.count_if(F.col("sentiment_label") == name).alias(name) for name in wanted]
    )


def label_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("rows"))
