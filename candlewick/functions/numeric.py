"""Arithmetic helpers that stay NULL where plain division would raise."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, functions as F

from candlewick.schemas import LABEL_SCORES


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; NULL when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def pct_change(value: Column, base: Column) -> Column:
    return ratio(value - base, base)


def safe_log(value: Column) -> Column:
    """Natural log; NULL for values that have none."""
    return F.when(value > 0, F.ln(value))


def recode(value: Column, mapping: dict[str, str]) -> Column:
    """Mapped value, or the value itself where the mapping has no entry."""
    if not mapping:
        return value
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(lookup, value), value)


def label_score(label: Column, scores: dict[str, float] | None = None) -> Column:
    """Score of a label after trimming and lower-casing; unknown labels score 0."""
    scores = scores or LABEL_SCORES
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(scores.items())])
    return F.coalesce(F.try_element_at(lookup, F.lower(F.trim(label))), F.lit(0.0))


def direction(change: Column) -> Column:
    return F.when(change > 0, F.lit("UP")).otherwise(F.lit("DOWN"))


def all_of(conditions: list[Column]) -> Column:
    """AND of the conditions; true for an empty list."""
    return reduce(lambda left, right: left & right, conditions, F.lit(True))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(text) == 0)
