"""Quality of predictions per group, computed from aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.functions.numeric import ratio
from candlewick.series import Series, attach, bucket_sizes, main_rows, split

# Fixed value: trading days per year.
TRADING_DAYS = 252


def _regression(actual: str, predicted: str) -> list[Column]:
    error = F.col(actual) - F.col(predicted)
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(actual).alias("_spread"),
        F.corr(actual, predicted).alias("pearson"),
    ]


def _regression_columns() -> list[Column]:
    flat = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("_spread") == 0, flat).otherwise(1 - ratio(F.col("mse"), F.col("_spread")))
    return [F.col("n"), F.col("mse"), F.sqrt("mse").alias("rmse"), F.col("mae"), r2.alias("r2"), F.col("pearson")]


def complete_pairs(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows with both values; a missing prediction must not count in one metric and be skipped in another."""
    return df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())


def regression_metrics(
    df: DataFrame, by: Sequence[str] = ("ticker",), actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """mse, rmse, mae, r2 and pearson in one aggregation, over the rows that hold both values."""
    return complete_pairs(df, actual, predicted).groupBy(*by).agg(*_regression(actual, predicted)).select(*by, *_regression_columns())


def _steps(series: Series, actual: str, predicted: str) -> list[Column]:
    w = series.window()
    return [
        (F.col(actual) - F.lag(actual).over(w)).alias("_move"),
        (F.col(predicted) - F.lag(predicted).over(w)).alias("_guess"),
    ]


def _direction() -> list[Column]:
    """Aggregates over steps; a group's first row has no step and counts nowhere."""
    hit = F.signum("_move") == F.signum("_guess")
    gain = F.when(F.col("_move").isNotNull(), F.when(hit, F.abs("_move")).otherwise(-F.abs("_move")))
    return [
        F.avg(F.when(F.col("_move").isNotNull(), F.coalesce(hit, F.lit(False)).cast("double"))).alias("direction_accuracy"),
        F.avg(gain).alias("_mean"),
        F.stddev_pop(gain).alias("_sd"),
    ]


def _sharpe() -> Column:
    return (
        F.when(F.col("_sd") > 0, math.sqrt(TRADING_DAYS) * F.col("_mean") / F.col("_sd")).otherwise(0.0).alias("sharpe")
    )


def direction_metrics(
    df: DataFrame,
    by: Sequence[str] = ("ticker",),
    order: Sequence[str] = ("fold", "row"),
    actual: str = "actual",
    predicted: str = "predicted",
    bucket: Column | None = None,
) -> DataFrame:
    """Share of steps where actual and prediction move the same way, and the Sharpe ratio of trading on it.

    Steps run across fold borders. ``bucket`` (not decreasing along the order, the fold for instance) splits long
    groups in blocks that overlap by one row.
    """
    series = Series(key=tuple(by), order=tuple(order))
    df = complete_pairs(df, actual, predicted)
    if bucket is None:
        stepped = df.select("*", *_steps(series, actual, predicted))
    else:
        parts, blocked = split(df, series, bucket, halo=1)
        stepped = main_rows(parts.select("*", *_steps(blocked, actual, predicted)))
    return stepped.groupBy(*by).agg(*_direction()).select(*by, "direction_accuracy", _sharpe())


#: Distinct values of a group that one task ranks, about.
RANKED_ROWS = 250_000


def centred_ranks(counts: DataFrame, value: str, by: Sequence[str], name: str, pieces: int | None = None) -> DataFrame:
    """Average rank minus the mean rank, per group and distinct value, from ``_count`` rows per value.

    No group is ranked in one task: quantile edges cut its distinct values into pieces, and the piece sizes add up to
    the ranks before each piece. Without a given number the largest group decides how many pieces there are.
    """
    by = list(by)
    known = counts.filter(F.col(value).isNotNull())
    if pieces is None:
        largest = known.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        pieces = max(2, -(-largest // RANKED_ROWS))
    steps = [i / pieces for i in range(1, pieces)]
    edges = known.groupBy(*by).agg(F.percentile_approx(value, steps, 100 * pieces).alias("_edges"), F.sum("_count").alias("_total"))
    placed = attach(known, edges, by).select(
        *by, value, "_count", "_total", F.size(F.filter("_edges", lambda e: e < F.col(value))).alias("_piece")
    )
    sizes = bucket_sizes(placed, Series(key=tuple(by), order=(value,)), "_piece", _rows=F.col("_count"))
    inside = Window.partitionBy(*by, "_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    lower = F.col("_rows_before") + F.coalesce(F.sum("_count").over(inside), F.lit(0))
    centred = lower + (F.col("_count") + 1) / 2 - (F.col("_total") + 1) / 2
    ranked = attach(placed, sizes.select(*by, "_piece", "_rows_before"), [*by, "_piece"])
    return ranked.select(*by, value, centred.alias(name))


def spearman(
    df: DataFrame, by: Sequence[str] = ("ticker",), actual: str = "actual", predicted: str = "predicted", name: str = "ic"
) -> DataFrame:
    """Rank correlation with average ranks for ties, for groups of any size.

    Equal pairs are counted first; every later step starts from that one shuffle.
    """
    by = list(by)
    complete = complete_pairs(df, actual, predicted)
    pairs = complete.groupBy(*by, actual, predicted).agg(F.count(F.lit(1)).alias("_pairs"))

    def ranks(value: str, alias: str) -> DataFrame:
        return centred_ranks(pairs.groupBy(*by, value).agg(F.sum("_pairs").alias("_count")), value, by, alias)

    ranked = attach(attach(pairs, ranks(actual, "_x"), [*by, actual]), ranks(predicted, "_y"), [*by, predicted])
    weight, x, y = F.col("_pairs"), F.col("_x"), F.col("_y")
    product = ratio(F.sum(weight * x * y), F.sqrt(F.sum(weight * x * x)) * F.sqrt(F.sum(weight * y * y)))
    return ranked.groupBy(*by).agg(product.alias(name))


def evaluate(
    df: DataFrame,
    by: Sequence[str] = ("ticker",),
    order: Sequence[str] = ("fold", "row"),
    actual: str = "actual",
    predicted: str = "predicted",
) -> DataFrame:
    """All metrics of daily predictions, one row per group, after one shuffle.

    A ticker has at most one prediction per day and fold, so its rows fit one task. For larger groups use
    ``regression_metrics``, ``direction_metrics`` with a bucket, and ``spearman``.
    """
    by = list(by)

    def average_rank(value: str, alias: str) -> Column:
        ties = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
        return (F.rank().over(Window.partitionBy(*by).orderBy(value)) + (ties - 1) / 2).alias(alias)

    stepped = complete_pairs(df, actual, predicted).select(
        *by,
        actual,
        predicted,
        *_steps(Series(key=tuple(by), order=tuple(order)), actual, predicted),
        average_rank(actual, "_x"),
        average_rank(predicted, "_y"),
    )
    stats = stepped.groupBy(*by).agg(*_regression(actual, predicted), *_direction(), F.corr("_x", "_y").alias("ic"))
    return stats.select(*by, *_regression_columns(), "direction_accuracy", _sharpe(), "ic")
