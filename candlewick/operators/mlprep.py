"""Training data from feature tables: folds, scaling, sequences, scoring windows.

Everything runs per key over daily rows, so one key never holds more rows than the calendar has days.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.functions.numeric import direction
from candlewick.schemas import FEATURES, TARGET
from candlewick.series import DAILY, Series

# Fixed value: ranges below this count as constant and scale by 1.
CONSTANT_RANGE = 10 * float(np.finfo(np.float64).eps)


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN in the columns (default: all)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def training_rows(df: DataFrame, ticker: str | None = None, target: str = TARGET) -> DataFrame:
    """Feature rows ready for training; the newest row of a ticker has no label yet and is left out."""
    kept = df if ticker is None else df.filter(F.col("ticker") == ticker)
    return complete_rows(kept, [c for c in FEATURES if c in df.columns] + [target])


# --- walk-forward folds ------------------------------------------------------------------------------


@dataclass(frozen=True)
class WalkForward:
    """Fold ``k`` tests rows ``[initial + k step, + window)`` of a key and trains on the rows before.

    Anchored folds train from row 0, rolling folds from row ``k step``. Folds with fewer train rows than
    ``look_back + 1`` or ``min_train`` are skipped, and only kept folds are numbered.
    """

    initial: int = 800
    window: int = 60
    step: int | None = None
    look_back: int = 45
    min_train: int | None = None
    anchored: bool = True

    @property
    def stride(self) -> int:
        return self.step or self.window

    @property
    def first_kept(self) -> int | None:
        """Index of the first fold with enough train rows; None when no fold has."""
        need = max(self.look_back + 1, self.min_train or 0)
        if self.initial >= need:
            return 0
        return -(-(need - self.initial) // self.stride) if self.anchored else None

    def fold_count(self, rows: Column) -> Column:
        """Folds that start inside ``rows`` rows, before skipping."""
        return F.greatest(F.ceil((rows - self.initial) / self.stride), F.lit(0)).cast("long")


def _range(low: Column, high: Column) -> Column:
    """Integers from low to high; none if low is above high."""
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def fold_table(counts: DataFrame, plan: WalkForward, rows: str = "n") -> DataFrame:
    """Row ranges of every fold: the input's columns plus fold, train and test bounds (end exclusive)."""
    first = plan.first_kept
    if first is None:
        folds = F.array().cast("array<bigint>")
        first = 0
    else:
        folds = _range(F.lit(first).cast("long"), plan.fold_count(F.col(rows)) - 1)
    k = F.col("_k")
    start = plan.initial + k * plan.stride
    return counts.select("*", F.explode(folds).alias("_k")).select(
        *counts.columns,
        (k - first).cast("long").alias("fold"),
        (F.lit(0).cast("long") if plan.anchored else k * plan.stride).alias("train_start"),
        start.alias("train_end"),
        start.alias("test_start"),
        F.least(start + plan.window, F.col(rows)).alias("test_end"),
    )


def fold_rows(df: DataFrame, plan: WalkForward, series: Series = DAILY) -> DataFrame:
    """Every row once per fold and split it belongs to; adds row, fold, split.

    The folds of a row follow from its row number by arithmetic, so there is no join.
    """
    first = plan.first_kept
    numbered = df.select(
        "*",
        (F.row_number().over(series.window()) - 1).cast("long").alias("row"),
        F.count(F.lit(1)).over(Window.partitionBy(*series.key)).alias("_n"),
    )
    if first is None:
        first, last = 0, F.lit(-1).cast("long")
    else:
        last = plan.fold_count(F.col("_n")) - 1
    row, lowest = F.col("row"), F.lit(first).cast("long")
    started = F.floor((row - plan.initial) / plan.stride)  # newest fold whose test part begins at or before the row
    train_last = last if plan.anchored else F.least(F.floor(row / plan.stride), last)
    train = _range(F.greatest(started + 1, lowest), train_last)
    test = _range(
        F.greatest(F.floor((row - plan.initial - plan.window) / plan.stride) + 1, lowest), F.least(started, last)
    )

    def tag(folds: Column, split: str) -> Column:
        return F.transform(folds, lambda k: F.struct((k - first).alias("fold"), F.lit(split).alias("split")))

    spread = numbered.select("*", F.explode(F.concat(tag(train, "train"), tag(test, "test"))).alias("_part"))
    return spread.select(*df.columns, "row", "_part.fold", "_part.split")


# --- scaling ---------------------------------------------------------------------------------------


def fit_minmax(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Low and width per group and column; a constant column gets width 1."""
    lows = [F.min(c).alias(f"low_{c}") for c in columns]
    widths = []
    for c in columns:
        width = F.max(c) - F.min(c)
        widths.append(F.when(width < CONSTANT_RANGE, 1.0).otherwise(width).alias(f"width_{c}"))
    return df.groupBy(*by).agg(*lows, *widths)


def fit_folds(df: DataFrame, columns: Sequence[str], plan: WalkForward, series: Series = DAILY) -> DataFrame:
    """Low and width per key, fold and column over the fold's train rows, without a copy of any row.

    The edges of all folds lie on a grid of rows. Extremes per cell of the grid are an aggregate; those of a fold are the running
    extremes up to its edge, or those of a fixed number of cells before it, over a table of cells.
    """
    first = plan.first_kept
    grid = math.gcd(plan.initial, plan.stride)
    numbered = df.select(*series.key, *columns, (F.row_number().over(series.window()) - 1).alias("_row"))
    extremes = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("_min", F.min), ("_max", F.max))]
    cells = numbered.groupBy(*series.key, F.floor(F.col("_row") / grid).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"), *extremes)
    by_key = Window.partitionBy(*series.key)
    frame = by_key.orderBy("_cell").rowsBetween(Window.unboundedPreceding if plan.anchored else 1 - plan.initial // grid, 0)
    spans = [f(f"{name}_{c}").over(frame).alias(f"{name}_{c}") for c in columns for name, f in (("_min", F.min), ("_max", F.max))]
    whole = cells.select(*series.key, "_cell", F.sum("_n").over(by_key).alias("_rows"), *spans)
    steps = (F.col("_cell") + 1) * grid - plan.initial
    k = F.floor(steps / plan.stride)
    there = (steps >= 0) & (steps % plan.stride == 0) & (k >= (first or 0)) & (k < plan.fold_count(F.col("_rows")))
    fitted = whole.filter(F.lit(first is not None) & there)
    lows = [F.col(f"_min_{c}").alias(f"low_{c}") for c in columns]
    wide = {c: F.col(f"_max_{c}") - F.col(f"_min_{c}") for c in columns}
    widths = [F.when(w < CONSTANT_RANGE, 1.0).otherwise(w).alias(f"width_{c}") for c, w in wide.items()]
    return fitted.select(*series.key, (k - (first or 0)).cast("long").alias("fold"), *lows, *widths)


def scale(df: DataFrame, scalers: DataFrame, columns: Sequence[str], by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Columns replaced by their scaled values."""
    return _rescaled(df, scalers, columns, by, lambda x, low, width: (x - low) / width)


def unscale(
    df: DataFrame,
    scalers: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = ("ticker",),
    fitted: Sequence[str] | None = None,
) -> DataFrame:
    """Columns back in original units; ``fitted`` names the scaler column to use for each."""
    return _rescaled(df, scalers, columns, by, lambda x, low, width: x * width + low, fitted)


def _rescaled(df, scalers, columns, by, formula, fitted=None) -> DataFrame:
    source = dict(zip(columns, fitted or columns, strict=True))
    joined = df.join(scalers, list(by), "left")
    return joined.select(
        *[
            formula(F.col(c), F.col(f"low_{source[c]}"), F.col(f"width_{source[c]}")).alias(c) if c in source else F.col(c)
            for c in df.columns
        ]
    )


# --- sequences -------------------------------------------------------------------------------------


def sequences(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    look_back: int = 45,
    stride: int = 1,
    by: Sequence[str] = ("ticker",),
    order: Sequence[str] = ("date",),
) -> DataFrame:
    """``look_back`` feature rows and the target of the row after them, every ``stride`` rows.

    ``start`` numbers the first row of the sequence inside its group; sequences never cross a group.
    """
    ordered = Window.partitionBy(*by).orderBy(*order)
    values = F.array(*[F.col(c).cast("double") for c in features])
    out = df.select(
        "*",
        (F.row_number().over(ordered) - 1 - look_back).cast("long").alias("start"),
        F.collect_list(values).over(ordered.rowsBetween(-look_back, -1)).alias("inputs"),
    )
    kept = out.filter((F.col("start") >= 0) & (F.col("start") % stride == 0))
    return kept.select(*by, *order, "start", "inputs", F.col(target).alias("target"))


def fold_sequences(
    df: DataFrame, features: Sequence[str], plan: WalkForward, target: str = TARGET, stride: int = 1, series: Series = DAILY
) -> DataFrame:
    """Scaled sequences of every fold and split; scalers see the train rows only."""
    by = [*series.key, "fold"]
    columns = [*features, target]
    rows = df.select(*series.key, *series.order, *columns)
    parts, fitted = fold_rows(rows, plan, series), fit_folds(rows, columns, plan, series)
    scaled = scale(parts, fitted, columns, by)
    return sequences(scaled, features, target, plan.look_back, stride, [*by, "split"], list(series.order))


# --- scoring ---------------------------------------------------------------------------------------


def newest_rows(df: DataFrame, n: int, series: Series = DAILY) -> DataFrame:
    """The last ``n`` rows per key. Spark cuts each task to ``n`` rows per key before the shuffle."""
    ranked = df.select("*", F.row_number().over(series.newest_first()).alias("_rank"))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def newest_window(
    df: DataFrame, features: Sequence[str], look_back: int = 45, series: Series = DAILY, short: str = "error"
) -> DataFrame:
    """One input sequence per key from its last ``look_back`` complete rows.

    Only features must be complete: the newest row has no label but is the one to predict from. A key with too few
    complete rows, or none at all, raises, or is left out with ``short="drop"``, or with ``short="row"`` keeps its row, with a message in
    ``error`` and without inputs.
    """
    whole = reduce(and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features], F.lit(True))
    marked = df.select("*", whole.alias("_whole"))
    place = F.row_number().over(Window.partitionBy(*series.partition).orderBy(F.desc("_whole"), *[F.desc(c) for c in series.order]))
    recent = marked.select("*", place.alias("_rank")).filter(F.col("_rank") <= look_back)
    values = F.array(*[F.col(c).cast("double") for c in features])
    entries = F.sort_array(F.collect_list(F.when(F.col("_whole"), F.struct(*series.order, values.alias("values")))))
    grouped = recent.groupBy(*series.key).agg(entries.alias("_rows"))
    enough = F.size("_rows") == look_back
    message = F.concat(F.lit(f"fewer than {look_back} rows for "), F.coalesce(F.col(series.key[0]).cast("string"), F.lit("NULL")))
    if short == "drop":
        grouped = grouped.filter(enough)
    elif short != "row":
        grouped = grouped.withColumn("_rows", F.when(enough, F.col("_rows")).otherwise(F.raise_error(message)))
    values = F.transform("_rows", lambda r: r["values"])
    out = [F.try_element_at("_rows", F.lit(-1))[series.order[0]].alias("last_date"), (F.when(enough, values) if short == "row" else values).alias("inputs")]
    return grouped.select(*series.key, *out, *([F.when(~enough, message).alias("error")] if short == "row" else []))


Predictor = Callable[[np.ndarray], np.ndarray]


def predict(windows: DataFrame, load: Callable[[], Predictor], inputs: str = "inputs", name: str = "prediction") -> DataFrame:
    """Model output per input sequence; ``load`` runs once per task and gets batches of shape (n, rows, features)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            if frame.empty:
                continue
            batch = np.stack([np.stack([np.asarray(r, dtype=float) for r in rows]) for rows in frame[inputs]])
            yield frame.drop(columns=[inputs]).assign(**{name: np.asarray(model(batch), dtype=float).reshape(-1)})

    kept = windows.drop(inputs)
    return windows.mapInPandas(run, f"{kept.schema.simpleString()[7:-1]},{name}:double")


def predict_or_explain(windows: DataFrame, load: Callable[[], Predictor], inputs: str = "inputs", name: str = "prediction") -> DataFrame:
    """As ``predict``, for rows that may have an ``error`` already: those pass through. A batch that the model refuses is tried row by row; a row that it
    refuses alone, or answers without a finite number, gets the reason as its ``error``."""

    def one(model: Predictor, window: list) -> tuple[float | None, str | None]:
        try:
            value = float(np.asarray(model(np.stack([np.asarray(r, dtype=float) for r in window])[None]), dtype=float).reshape(-1)[0])
            return (value, None) if np.isfinite(value) else (None, "the model gave no finite number")
        except Exception as problem:
            return None, str(problem) or type(problem).__name__

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for frame in frames:
            good = frame["error"].isna().to_numpy()
            values, errors = np.full(len(frame), None, object), frame["error"].to_numpy(object, copy=True)
            windows_ = frame[inputs].to_numpy()
            if good.any():
                model = model or load()
                try:
                    found = np.asarray(model(np.stack([np.stack([np.asarray(r, dtype=float) for r in w]) for w in windows_[good]])), dtype=float).reshape(-1)
                    if len(found) != good.sum() or not np.isfinite(found).all():
                        raise ValueError("the batch has no number for each row")
                    values[good] = found
                except Exception:
                    for k in np.flatnonzero(good):
                        values[k], errors[k] = one(model, windows_[k])
            yield frame.drop(columns=[inputs]).assign(error=errors, **{name: pd.Series(values, dtype=float, index=frame.index)})

    kept = windows.drop(inputs)
    found = windows.mapInPandas(run, f"{kept.schema.simpleString()[7:-1]},{name}:double")
    return found.withColumn(name, F.when(F.col("error").isNull(), F.col(name)))


def _report_columns(model_name: str, look_back: int, features: int, value: str = "prediction", ticker: str = "ticker") -> list[Column]:
    return [
        F.col(ticker).alias("stock"),
        F.col("last_date").cast("string").alias("last_data_date"),
        F.col(value).alias("predicted_next_day_return"),
        (F.col(value) * 100).alias("predicted_return_pct"),
        direction(F.col(value)).alias("prediction_direction"),
        F.lit(model_name).alias("model_name"),
        F.lit(look_back).alias("look_back_window"),
        F.lit(features).alias("features_used"),
    ]


def prediction_report(
    df: DataFrame, model_name: str, look_back: int, features: int, value: str = "prediction", ticker: str = "ticker"
) -> DataFrame:
    """Result rows of a scoring run."""
    return df.select(*_report_columns(model_name, look_back, features, value, ticker))


def score_newest(
    df: DataFrame,
    features: Sequence[str],
    scalers: DataFrame,
    load: Callable[[], Predictor],
    model_name: str,
    look_back: int = 45,
    target: str = TARGET,
    short: str = "error",
) -> DataFrame:
    """Scale, predict from the newest rows of every ticker, and report in original units."""
    if short == "row":
        raise ValueError("error rows have a report of their own: score_or_explain")
    scaled = scale(df.select("ticker", "date", *features), scalers, features)
    raw = predict(newest_window(scaled, features, look_back, short=short), load)
    result = unscale(raw, scalers, ["prediction"], fitted=[target])
    return prediction_report(result, model_name, look_back, len(features))


def score_or_explain(
    df: DataFrame,
    features: Sequence[str],
    scalers: DataFrame,
    load: Callable[[], Predictor],
    model_name: str,
    now: Column | None = None,
    look_back: int = 45,
    target: str = TARGET,
) -> DataFrame:
    """The report of ``score_newest`` with a row for every ticker: its prediction, or why there is none.

    ``timestamp`` is the time of the run, ``status`` ok or failed, ``error`` the reason. One ticker without enough rows, without a scaler or refused by the
    model costs the others nothing.
    """
    scaled = scale(df.select("ticker", "date", *features), scalers, features)
    raw = predict_or_explain(newest_window(scaled, features, look_back, short="row"), load)
    result = unscale(raw, scalers, ["prediction"], fitted=[target])
    failed = F.col("error").isNotNull()
    stock, *others = _report_columns(model_name, look_back, len(features))
    names = prediction_report(result, model_name, look_back, len(features)).columns[1:]
    stamp = F.current_timestamp() if now is None else now
    return result.select(
        stamp.alias("timestamp"),
        stock,
        *[F.when(~failed, c).alias(name) for name, c in zip(names, others, strict=True)],
        "error",
        F.when(failed, "failed").otherwise("ok").alias("status"),
    )
