"""Folds, scaling, sequences, scoring and metrics over the daily features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from candlewick.operators import metrics as mt, mlprep as ml
from candlewick.plans import inputs
from candlewick.plans.catalogue.registry import query, rounded, rounded_sql

PLAN = ml.WalkForward(initial=800, window=60, step=60, look_back=45)
ROLLING = ml.WalkForward(initial=600, window=80, step=50, look_back=45, anchored=False)
SHORT = ml.WalkForward(initial=40, window=90, step=100, look_back=45, min_train=300)
COLUMNS = inputs.FEATURE_COLUMNS
ALL = [*COLUMNS, "next_day_return"]

_ROWS = f"""{inputs.FEATURES}, complete AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS rn, count(*) OVER (PARTITION BY ticker) AS n
  FROM features WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ALL)})"""


def _complete(spark, d):
    return ml.complete_rows(inputs.features(spark, d), ALL)


def _folds_sql(plan: ml.WalkForward) -> str:
    """Folds by stepping through every start, then numbering the kept ones."""
    train_start = "0" if plan.anchored else f"k * {plan.stride}"
    need = max(plan.look_back + 1, plan.min_train or 0)
    return f"""counts AS (SELECT ticker, count(*) AS n FROM complete GROUP BY 1), steps AS (
  SELECT ticker, n, k, {train_start} AS train_start, {plan.initial} + k * {plan.stride} AS test_start
  FROM counts, LATERAL (SELECT unnest(range(0, n)) AS k) s WHERE {plan.initial} + k * {plan.stride} < n),
folds AS (SELECT ticker, n, row_number() OVER (PARTITION BY ticker ORDER BY k) - 1 AS fold, CAST(train_start AS BIGINT) AS train_start,
  CAST(test_start AS BIGINT) AS train_end, CAST(test_start AS BIGINT) AS test_start,
  CAST(least(test_start + {plan.window}, n) AS BIGINT) AS test_end FROM steps WHERE test_start - train_start >= {need})"""


_PARTS = """parts AS (
  SELECT c.*, f.fold, 'train' AS split FROM complete c JOIN folds f ON f.ticker = c.ticker AND rn >= train_start AND rn < train_end
  UNION ALL
  SELECT c.*, f.fold, 'test' FROM complete c JOIN folds f ON f.ticker = c.ticker AND rn >= test_start AND rn < test_end)"""


def _register_folds(name: str, plan: ml.WalkForward) -> None:
    @query(f"folds_{name}", f"WITH {_ROWS}, {_folds_sql(plan)} SELECT * FROM folds")
    def folds(spark, d):
        counts = _complete(spark, d).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
        return ml.fold_table(counts, plan)

    @query(
        f"fold_rows_{name}",
        f"WITH {_ROWS}, {_folds_sql(plan)}, {_PARTS} SELECT ticker, date, rn AS row, fold, split FROM parts",
    )
    def rows(spark, d):
        return ml.fold_rows(_complete(spark, d), plan).select("ticker", "date", "row", "fold", "split")


for _name, _plan in (("anchored", PLAN), ("rolling", ROLLING), ("skipping", SHORT)):
    _register_folds(_name, _plan)

_SCALERS = "scalers AS (SELECT ticker, fold, " + ", ".join(
    f"min({c}) AS low_{c}, CASE WHEN max({c}) - min({c}) < 2.220446049250313e-15 THEN 1.0 ELSE max({c}) - min({c}) END AS width_{c}"
    for c in ALL
) + " FROM parts WHERE split = 'train' GROUP BY ticker, fold)"
_SHOWN = [f"{side}_{c}" for c in ALL for side in ("low", "width")]
_FITTED = f"WITH {_ROWS}, {_folds_sql(PLAN)}, {_PARTS}, {_SCALERS}"


@query("fold_scalers", f"{_FITTED} SELECT ticker, fold, {', '.join(rounded_sql(c, 4) for c in _SHOWN)} FROM scalers")
def fold_scalers(spark, d):
    fitted = ml.fit_folds(_complete(spark, d), ALL, PLAN)
    return fitted.select("ticker", "fold", *[rounded(c, 4) for c in _SHOWN])


_SCALED = "scaled AS (SELECT p.ticker, p.date, p.rn, p.fold, p.split, " + ", ".join(
    f"(p.{c} - s.low_{c}) / s.width_{c} AS {c}" for c in ALL
) + " FROM parts p JOIN scalers s ON s.ticker = p.ticker AND s.fold = p.fold)"


@query(
    "scaled_folds",
    f"{_FITTED}, {_SCALED} SELECT ticker, date, fold, split, {', '.join(rounded_sql(c) for c in ALL)} FROM scaled",
)
def scaled_folds(spark, d):
    by = ["ticker", "fold"]
    rows = _complete(spark, d)
    out = ml.scale(ml.fold_rows(rows, PLAN), ml.fit_folds(rows, ALL, PLAN), ALL, by)
    return out.select("ticker", "date", "fold", "split", *[rounded(c) for c in ALL])


@query(
    "unscaled_rows",
    f"WITH {_ROWS} SELECT ticker, date, {', '.join(rounded_sql(c, 4) for c in ALL)} FROM complete",
)
def unscaled_rows(spark, d):
    """Scaling and its inverse give the rows back."""
    rows = _complete(spark, d)
    fitted = ml.fit_minmax(rows, ALL)
    back = ml.unscale(ml.scale(rows, fitted, ALL), fitted, ALL)
    return back.select("ticker", "date", *[rounded(c, 4) for c in ALL])


def _flat(name: str = "inputs"):
    """Sum of each feature over the sequence, and its first and last value."""

    def sum_of(i: int):
        return F.aggregate(name, F.lit(0.0), lambda total, row: total + row[i])

    out = []
    for i, c in enumerate(COLUMNS):
        total = sum_of(i)
        out += [rounded(total, 4, f"sum_{c}"), rounded(F.element_at(name, 1)[i], 4, f"first_{c}")]
        out += [rounded(F.element_at(name, -1)[i], 4, f"last_{c}")]
    return out


def _sequence_sql(source: str, by: str, rows: int, stride: int, order: str = "date") -> str:
    frame = f"OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"
    cells = ", ".join(
        f"{rounded_sql(f'sum({c}) {frame}', 4, f'sum_{c}')}, {rounded_sql(f'first({c}) {frame}', 4, f'first_{c}')}, "
        f"{rounded_sql(f'last({c}) {frame}', 4, f'last_{c}')}"
        for c in COLUMNS
    )
    return f"""SELECT * FROM (SELECT {by}, {order}, row_number() OVER (PARTITION BY {by} ORDER BY {order}) - 1 - {rows} AS start,
  {rounded_sql("next_day_return", 6, "target")}, {cells} FROM {source}) WHERE start >= 0 AND start % {stride} = 0"""


@query("sequences", f"WITH {_ROWS} {_sequence_sql('complete', 'ticker', 45, 1)}")
def sequences(spark, d):
    out = ml.sequences(_complete(spark, d), COLUMNS)
    return out.select("ticker", "date", "start", rounded("target"), *_flat())


@query("sequences_with_stride", f"WITH {_ROWS} {_sequence_sql('complete', 'ticker', 30, 7)}")
def sequences_with_stride(spark, d):
    out = ml.sequences(_complete(spark, d), COLUMNS, look_back=30, stride=7)
    return out.select("ticker", "date", "start", rounded("target"), *_flat())


@query("fold_sequences", f"{_FITTED}, {_SCALED} {_sequence_sql('scaled', 'ticker, fold, split', 45, 1)}")
def fold_sequences(spark, d):
    out = ml.fold_sequences(_complete(spark, d), COLUMNS, PLAN)
    return out.select("ticker", "fold", "split", "date", "start", rounded("target"), *_flat())


# --- scoring -------------------------------------------------------------------------------------------

_RECENT = f"""{inputs.FEATURES}, recent AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS back FROM features
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in COLUMNS)} QUALIFY back <= 45)"""


@query(
    "newest_window",
    f"WITH {_RECENT} SELECT ticker, max(date) AS last_date, "
    + ", ".join(
        f"{rounded_sql(f'sum({c})', 4, f'sum_{c}')}, {rounded_sql(f'arg_min({c}, date)', 4, f'first_{c}')}, "
        f"{rounded_sql(f'arg_max({c}, date)', 4, f'last_{c}')}"
        for c in COLUMNS
    )
    + " FROM recent GROUP BY ticker",
)
def newest_window(spark, d):
    """The newest row has no label yet, but is the one to predict from."""
    out = ml.newest_window(inputs.features(spark, d), COLUMNS)
    return out.select("ticker", "last_date", *_flat())


def _load_mean():
    """A model stand-in: the mean of the last scaled row."""

    def run(batch: np.ndarray) -> np.ndarray:
        return batch[:, -1, :].mean(axis=1)

    return run


_SCALE_ALL = "fitted AS (SELECT ticker, " + ", ".join(
    f"min({c}) AS low_{c}, max({c}) - min({c}) AS width_{c}" for c in ALL
) + " FROM complete GROUP BY ticker)"


@query(
    "predictions",
    f"""WITH {_ROWS}, {_SCALE_ALL}, recent AS (
  SELECT * FROM features WHERE {' AND '.join(f'{c} IS NOT NULL' for c in COLUMNS)}
  QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1),
p AS (SELECT r.ticker, r.date, ({' + '.join(f'(r.{c} - f.low_{c}) / f.width_{c}' for c in COLUMNS)}) / {len(COLUMNS)}
  * f.width_next_day_return + f.low_next_day_return AS value FROM recent r JOIN fitted f ON f.ticker = r.ticker)
SELECT ticker AS stock, CAST(date AS VARCHAR) AS last_data_date, {rounded_sql("value", 6, "predicted_next_day_return")},
  {rounded_sql("value * 100", 4, "predicted_return_pct")}, CASE WHEN value > 0 THEN 'UP' ELSE 'DOWN' END AS prediction_direction,
  'mean' AS model_name, 45 AS look_back_window, {len(COLUMNS)} AS features_used FROM p""",
)
def predictions(spark, d):
    features = inputs.features(spark, d)
    fitted = ml.fit_minmax(ml.complete_rows(features, ALL), ALL)
    out = ml.score_newest(features, COLUMNS, fitted, _load_mean, "mean")
    digits = {"predicted_next_day_return": 6, "predicted_return_pct": 4}
    return out.select(*[rounded(c, digits[c]) if c in digits else F.col(c) for c in out.columns])


_RUN = "2024-06-01 08:00:00"


@query(
    "predictions_with_errors",
    f"""WITH {_ROWS}, {_SCALE_ALL}, newest AS (
  SELECT *, count(*) OVER (PARTITION BY ticker) AS here FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS back FROM features
    WHERE {' AND '.join(f'{c} IS NOT NULL' for c in COLUMNS)}) WHERE back <= CASE WHEN ticker = '1-URGENT' THEN 20 ELSE 45 END
  QUALIFY back = 1),
p AS (SELECT r.ticker, r.date, here, ({' + '.join(f'(r.{c} - f.low_{c}) / f.width_{c}' for c in COLUMNS)}) / {len(COLUMNS)}
  * f.width_next_day_return + f.low_next_day_return AS value FROM newest r JOIN fitted f ON f.ticker = r.ticker)
SELECT TIMESTAMP '{_RUN}' AS timestamp, ticker AS stock, CASE WHEN here >= 45 THEN CAST(date AS VARCHAR) END AS last_data_date,
  CASE WHEN here >= 45 THEN {rounded_sql("value", 6, "x")[:-5]} END AS predicted_next_day_return,
  CASE WHEN here >= 45 THEN CASE WHEN value > 0 THEN 'UP' ELSE 'DOWN' END END AS prediction_direction,
  CASE WHEN here >= 45 THEN 'mean' END AS model_name, CASE WHEN here < 45 THEN 'fewer than 45 rows for ' || ticker END AS error,
  CASE WHEN here < 45 THEN 'failed' ELSE 'ok' END AS status FROM p""",
)
def predictions_with_errors(spark, d):
    """One ticker has twenty rows left: it gets an error row, the others their prediction."""
    features = inputs.features(spark, d)
    fitted = ml.fit_minmax(ml.complete_rows(features, ALL), ALL)
    left = ml.newest_rows(ml.complete_rows(features, COLUMNS), 20).filter("ticker = '1-URGENT'").unionByName(features.filter("ticker <> '1-URGENT'"))
    out = ml.score_or_explain(left, COLUMNS, fitted, _load_mean, "mean", F.lit(_RUN).cast("timestamp"))
    shown = ["timestamp", "stock", "last_data_date", rounded("predicted_next_day_return"), "prediction_direction", "model_name", "error", "status"]
    return out.select(*shown)


# --- metrics -------------------------------------------------------------------------------------------

_PREDICTED = f"""WITH {_ROWS}, {_folds_sql(PLAN)}, p AS (
  SELECT c.ticker, f.fold, c.rn AS "row", next_day_return AS actual, Return AS predicted FROM complete c
  JOIN folds f ON f.ticker = c.ticker AND rn >= test_start AND rn < test_end)"""


def _predicted(spark, d):
    """Walk-forward test rows with the last return as the prediction."""
    test = ml.fold_rows(_complete(spark, d), PLAN).filter("split = 'test'")
    return test.select("ticker", "fold", "row", F.col("next_day_return").alias("actual"), F.col("Return").alias("predicted"))


_REGRESSION = """avg((actual - predicted) ** 2) AS mse, sqrt(avg((actual - predicted) ** 2)) AS rmse,
  avg(abs(actual - predicted)) AS mae, 1 - avg((actual - predicted) ** 2) / var_pop(actual) AS r2, corr(actual, predicted) AS pearson"""
_REGRESSED = ["mse", "rmse", "mae", "r2", "pearson"]


@query(
    "regression_metrics",
    f"{_PREDICTED}, m AS (SELECT ticker, count(*) AS n, {_REGRESSION} FROM p GROUP BY ticker) "
    f"SELECT ticker, n, {', '.join(rounded_sql(c) for c in _REGRESSED)} FROM m",
)
def regression_metrics(spark, d):
    out = mt.regression_metrics(_predicted(spark, d))
    return out.select("ticker", "n", *[rounded(c) for c in _REGRESSED])


_MOVES = """moves AS (SELECT ticker, actual - lag(actual) OVER w AS a, predicted - lag(predicted) OVER w AS g FROM p
  WINDOW w AS (PARTITION BY ticker ORDER BY fold, "row")),
gains AS (SELECT ticker, sign(a) = sign(g) AS hit, CASE WHEN sign(a) = sign(g) THEN abs(a) ELSE -abs(a) END AS gain
  FROM moves WHERE a IS NOT NULL),
d AS (SELECT ticker, avg(CASE WHEN hit THEN 1.0::DOUBLE ELSE 0.0 END) AS direction_accuracy,
  CASE WHEN stddev_pop(gain) > 0 THEN sqrt(252) * avg(gain) / stddev_pop(gain) ELSE 0.0 END AS sharpe FROM gains GROUP BY ticker)"""


@query("direction_metrics", f"{_PREDICTED}, {_MOVES} SELECT ticker, {rounded_sql('direction_accuracy')}, {rounded_sql('sharpe')} FROM d")
def direction_metrics(spark, d):
    out = mt.direction_metrics(_predicted(spark, d), bucket=F.col("fold"))
    return out.select("ticker", rounded("direction_accuracy"), rounded("sharpe"))


_RANKS = """ranks AS (SELECT ticker,
  rank() OVER (PARTITION BY ticker ORDER BY actual) + (count(*) OVER (PARTITION BY ticker, actual) - 1) / 2.0 AS x,
  rank() OVER (PARTITION BY ticker ORDER BY predicted) + (count(*) OVER (PARTITION BY ticker, predicted) - 1) / 2.0 AS y FROM p),
s AS (SELECT ticker, corr(CAST(x AS DOUBLE), CAST(y AS DOUBLE)) AS ic FROM ranks GROUP BY ticker)"""


@query("rank_correlation", f"{_PREDICTED}, {_RANKS} SELECT ticker, {rounded_sql('ic')} FROM s")
def rank_correlation(spark, d):
    return mt.spearman(_predicted(spark, d)).select("ticker", rounded("ic"))


_LINES = """WITH p AS (SELECT l_returnflag AS ticker, l_quantity AS actual, l_extendedprice AS predicted FROM lineitem)"""


@query("rank_correlation_large_groups", f"{_LINES}, {_RANKS} SELECT ticker, {rounded_sql('ic')} FROM s")
def rank_correlation_large_groups(spark, d):
    """Three keys share all lines, with many ties."""
    lines = inputs.table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("ticker"), F.col("l_quantity").alias("actual"), F.col("l_extendedprice").alias("predicted")
    )
    return mt.spearman(lines).select("ticker", rounded("ic"))


_EVERY = [*_REGRESSED, "direction_accuracy", "sharpe", "ic"]


@query(
    "evaluation",
    f"{_PREDICTED}, m AS (SELECT ticker, count(*) AS n, {_REGRESSION} FROM p GROUP BY ticker), {_MOVES}, {_RANKS} "
    f"SELECT ticker, n, {', '.join(rounded_sql(c) for c in _EVERY)} FROM m JOIN d USING (ticker) JOIN s USING (ticker)",
)
def evaluation(spark, d):
    out = mt.evaluate(_predicted(spark, d))
    return out.select("ticker", "n", *[rounded(c) for c in _EVERY])
