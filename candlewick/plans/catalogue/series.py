"""Indicators over daily bars and over ticks."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.operators import indicators as ind
from candlewick.operators.recurrence import ema_any_size
from candlewick.operators.shaping import bars_with_indicators
from candlewick.plans import inputs
from candlewick.plans.catalogue.registry import query, rounded, rounded_sql
from candlewick.schemas import PRICE_FEATURES
from candlewick.series import TICKS, main_rows, running_total, split

_W = "WINDOW w AS (PARTITION BY ticker ORDER BY date)"


def _trail(expression: str, n: int) -> str:
    return f"{expression} OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _ema_sql(value: str, alpha: str, partition: str = "ticker", order: str = "date") -> str:
    """Recursive average of all values up to the row."""
    return (
        f"list_reduce(list({value}) OVER (PARTITION BY {partition} ORDER BY {order} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), lambda a, x: a * (1 - {alpha}) + x * {alpha})"
    )


def _select(columns: list[str], source: str, digits: int = 6) -> str:
    return f"SELECT ticker, date, {', '.join(rounded_sql(c, digits) for c in columns)} FROM {source}"


def _shown(df, columns, digits=6):
    return df.select("ticker", "date", *[rounded(c, digits) for c in columns])


_SMA = [f"MA_{n}" for n in ind.SMA_LENGTHS]


@query(
    "sma",
    f"WITH {inputs.BARS}, x AS (SELECT *, "
    + ", ".join(f"{_trail('avg(close)', n)} AS MA_{n}" for n in ind.SMA_LENGTHS)
    + f" FROM bars) {_select(_SMA, 'x', 4)}",
)
def sma(spark, d):
    return _shown(ind.sma(inputs.bars(spark, d)), _SMA, 4)


_EMA = [f"EMA_{n}" for n in ind.EMA_SPANS]


@query(
    "ema",
    f"WITH {inputs.BARS}, x AS (SELECT *, "
    + ", ".join(f"{_ema_sql('close', f'(2.0::DOUBLE / {n + 1})')} AS EMA_{n}" for n in ind.EMA_SPANS)
    + f" FROM bars) {_select(_EMA, 'x', 4)}",
)
def ema(spark, d):
    return _shown(ind.ema(inputs.bars(spark, d)), _EMA, 4)


_MACD = ["MACD", "MACD_signal", "MACD_hist"]
_MACD_SQL = f"""line AS (
  SELECT *, {_ema_sql('close', '(2.0::DOUBLE / 13)')} - {_ema_sql('close', '(2.0::DOUBLE / 27)')} AS MACD,
         {_ema_sql('close', '(2.0::DOUBLE / 27)')} AS EMA_26 FROM bars),
macd AS (SELECT *, {_ema_sql('MACD', '0.2::DOUBLE')} AS MACD_signal FROM line)"""


@query(
    "macd",
    f"WITH {inputs.BARS}, {_MACD_SQL}, x AS (SELECT *, MACD - MACD_signal AS MACD_hist FROM macd) {_select(_MACD, 'x', 4)}",
)
def macd(spark, d):
    return _shown(ind.macd(inputs.bars(spark, d)), _MACD, 4)


_RSI_SQL = f"""moves AS (SELECT *, coalesce(close - lag(close) OVER w, 0) AS delta FROM {{source}} {_W}),
averages AS (SELECT *, {_ema_sql('greatest(delta, 0)', '(1.0::DOUBLE / 14)')} AS up,
                    {_ema_sql('greatest(-delta, 0)', '(1.0::DOUBLE / 14)')} AS down FROM moves),
rsi AS (SELECT *, CASE WHEN down = 0 AND up > 0 THEN 100.0 ELSE 100 - 100 / (1 + up / nullif(down, 0)) END AS RSI
        FROM averages)"""


@query("rsi", f"WITH {inputs.BARS}, {_RSI_SQL.format(source='bars')} {_select(['RSI'], 'rsi')}")
def rsi(spark, d):
    return _shown(ind.rsi(inputs.bars(spark, d)), ["RSI"])


def _gap_ema_sql(alpha: str) -> str:
    """The same where rows may lack a value: one step over the known values, whose weights decay over the gaps."""
    step = f"lambda a, x: {{{{'y': (pow(1 - {alpha}, x.s) * a.y + {alpha} * x.y) / (pow(1 - {alpha}, x.s) + {alpha}), 's': x.s}}}}"
    return f"list_reduce(list({{{{'y': close, 's': CAST(steps AS DOUBLE)}}}}) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING), {step}).y".replace("{{", "{").replace("}}", "}")


_WEEKDAY = "date_diff('day', DATE '1970-01-01', date) % 7 = 3"
_GAPS = ["EMA_12", "EMA_200", "MACD", "MACD_signal", "RSI"]


@query(
    "averages_with_gaps",
    f"""WITH {inputs.BARS}, gappy AS (SELECT ticker, date, CASE WHEN {_WEEKDAY} THEN NULL ELSE close END AS close,
    row_number() OVER (PARTITION BY ticker ORDER BY date) AS n FROM bars),
known AS (SELECT ticker, date, close, n - coalesce(lag(n) OVER w, n) AS steps FROM gappy WHERE close IS NOT NULL {_W}),
average AS (SELECT ticker, date, {", ".join(f"{_gap_ema_sql(f'(2.0::DOUBLE / {n + 1})')} AS e{n}" for n in (12, 26, 200))} FROM known),
carried AS (SELECT ticker, date, close, {", ".join(f"last_value(e{n} IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS EMA_{n}" for n in (12, 26, 200))}
  FROM gappy LEFT JOIN average USING (ticker, date)),
line AS (SELECT ticker, date, {_ema_sql('EMA_12 - EMA_26', '0.2::DOUBLE')} AS MACD_signal FROM carried WHERE EMA_12 IS NOT NULL),
{_RSI_SQL.format(source='carried')}, x AS (SELECT rsi.*, EMA_12 - EMA_26 AS MACD, MACD_signal FROM rsi LEFT JOIN line USING (ticker, date))
{_select(_GAPS, 'x', 4)}""",
)
def averages_with_gaps(spark, d):
    """Bars that lack the price of every Sunday."""
    missing = F.pmod(F.unix_date("date"), F.lit(7)) == 3
    bars = inputs.bars(spark, d).withColumn("close", F.when(~missing, F.col("close")))
    return _shown(ind.rsi(ind.macd(ind.ema(bars, [12, 200]))), _GAPS, 4)


_STOCH_SQL = f"(close - {_trail('min(low)', 14)}) / nullif({_trail('max(high)', 14)} - {_trail('min(low)', 14)}, 0) * 100"


@query(
    "stochastic",
    f"WITH {inputs.BARS}, k AS (SELECT *, {_STOCH_SQL} AS Stoch_K FROM bars), "
    f"x AS (SELECT *, {_trail('avg(Stoch_K)', 3)} AS Stoch_D FROM k) {_select(['Stoch_K', 'Stoch_D'], 'x')}",
)
def stochastic(spark, d):
    return _shown(ind.stochastic(inputs.bars(spark, d)), ["Stoch_K", "Stoch_D"])


@query(
    "roc",
    f"WITH {inputs.BARS}, x AS (SELECT *, (close - lag(close, 12) OVER w) / nullif(lag(close, 12) OVER w, 0) * 100 AS ROC "
    f"FROM bars {_W}) {_select(['ROC'], 'x')}",
)
def roc(spark, d):
    return _shown(ind.roc(inputs.bars(spark, d)), ["ROC"])


_BB = ["BB_middle", "BB_upper", "BB_lower", "BB_width"]


@query(
    "bollinger",
    f"WITH {inputs.BARS}, b AS (SELECT *, {_trail('avg(close)', 20)} AS BB_middle, "
    f"{_trail('stddev_samp(close)', 20)} AS sd FROM bars), x AS (SELECT *, BB_middle + 2 * sd AS BB_upper, "
    f"BB_middle - 2 * sd AS BB_lower, 4 * sd AS BB_width FROM b) {_select(_BB, 'x', 4)}",
)
def bollinger(spark, d):
    return _shown(ind.bollinger(inputs.bars(spark, d)), _BB, 4)


_RANGE_SQL = "greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w))"


@query(
    "atr",
    f"WITH {inputs.BARS}, r AS (SELECT *, {_RANGE_SQL} AS true_range FROM bars {_W}), "
    f"x AS (SELECT *, {_trail('avg(true_range)', 14)} AS ATR FROM r) {_select(['true_range', 'ATR'], 'x', 4)}",
)
def atr(spark, d):
    return _shown(ind.atr(inputs.bars(spark, d)), ["true_range", "ATR"], 4)


_OBV_SQL = f"""signed AS (SELECT *, coalesce(sign(close - lag(close) OVER w), 0) * volume AS sv FROM {{source}} {_W}),
obv AS (SELECT *, sum(sv) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS OBV FROM signed)"""


@query(
    "obv",
    f"WITH {inputs.BARS}, {_OBV_SQL.format(source='bars')}, "
    f"x AS (SELECT *, OBV - lag(OBV) OVER w AS OBV_change FROM obv {_W}) {_select(['OBV', 'OBV_change'], 'x')}",
)
def obv(spark, d):
    return _shown(ind.obv(inputs.bars(spark, d)), ["OBV", "OBV_change"])


_VWAP_SQL = (
    "sum((high + low + close) / 3 * volume) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) / "
    "nullif(sum(volume) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING), 0)"
)


@query("vwap", f"WITH {inputs.BARS}, x AS (SELECT *, {_VWAP_SQL} AS VWAP FROM bars) {_select(['VWAP'], 'x', 4)}")
def vwap(spark, d):
    return _shown(ind.vwap(inputs.bars(spark, d)), ["VWAP"], 4)


@query(
    "volume_average",
    f"WITH {inputs.BARS}, x AS (SELECT *, {_trail('avg(volume)', 20)} AS Volume_MA FROM bars) {_select(['Volume_MA'], 'x')}",
)
def volume_average(spark, d):
    return _shown(ind.volume_average(inputs.bars(spark, d)), ["Volume_MA"])


_RETURNS = ["Return", "Log_Return"]
_RETURN_SQL = "(close - lag(close) OVER w) / nullif(lag(close) OVER w, 0)"


@query(
    "returns",
    f"WITH {inputs.BARS}, x AS (SELECT *, {_RETURN_SQL} AS Return, "
    f"CASE WHEN close / nullif(lag(close) OVER w, 0) > 0 THEN ln(close / nullif(lag(close) OVER w, 0)) END AS Log_Return "
    f"FROM bars {_W}) {_select(_RETURNS, 'x')}",
)
def returns(spark, d):
    return _shown(ind.returns(inputs.bars(spark, d)), _RETURNS)


_CHANGES = ["Price_Change", "Price_Change_Pct", "High_Low_Range", "Open_Close_Range"]


@query(
    "price_changes",
    f"WITH {inputs.BARS}, x AS (SELECT *, close - lag(close) OVER w AS Price_Change, {_RETURN_SQL} * 100 AS Price_Change_Pct, "
    f"high - low AS High_Low_Range, close - open AS Open_Close_Range FROM bars {_W}) {_select(_CHANGES, 'x')}",
)
def price_changes(spark, d):
    return _shown(ind.price_changes(inputs.bars(spark, d)), _CHANGES)


@query(
    "forward_label",
    f"WITH {inputs.FEATURES} {_select(['Return', 'next_day_return'], 'features')}",
)
def forward_label(spark, d):
    return _shown(inputs.features(spark, d), ["Return", "next_day_return"])


def indicator_set_sql(source: str, report: str) -> str:
    """Every feature of the model in one statement, as table ``x`` for the report."""
    return f"""WITH {source}, {_MACD_SQL}, {_RSI_SQL.format(source='macd')}, {_OBV_SQL.format(source='rsi')},
ranged AS (SELECT *, {_RANGE_SQL} AS true_range, {_STOCH_SQL} AS Stoch_K,
  (close - lag(close, 12) OVER w) / nullif(lag(close, 12) OVER w, 0) * 100 AS ROC, {_RETURN_SQL} AS Return FROM obv {_W}),
x AS (SELECT *, {_trail('avg(close)', 20)} AS MA_20, {_trail('avg(close)', 200)} AS MA_200,
  4 * {_trail('stddev_samp(close)', 20)} AS BB_width, {_trail('avg(true_range)', 14)} AS ATR, {_VWAP_SQL} AS VWAP,
  Return * 100 AS Price_Change_Pct, high - low AS High_Low_Range, close - open AS Open_Close_Range FROM ranged)
{report}"""


_SET = _select(PRICE_FEATURES, "x", 4)


@query("indicator_set", indicator_set_sql(inputs.BARS, _SET))
def indicator_set(spark, d):
    return _shown(ind.indicator_set(inputs.bars(spark, d)), PRICE_FEATURES, 4)


@query("indicator_set_by_supplier", indicator_set_sql(inputs.SUPPLIER_BARS, _SET))
def indicator_set_by_supplier(spark, d):
    return _shown(ind.indicator_set(inputs.supplier_bars(spark, d)), PRICE_FEATURES, 4)


@query("indicator_set_in_blocks", indicator_set_sql(inputs.SUPPLIER_BARS, _SET))
def indicator_set_in_blocks(spark, d):
    """The same set with every supplier cut into blocks of about 300 bars."""
    out = ind.indicator_set_any_size(inputs.supplier_bars(spark, d), block_rows=300)
    return _shown(out, PRICE_FEATURES, 4)


@query(
    "bars_with_indicators",
    f"WITH {inputs.BARS}, x AS (SELECT *, {_trail('avg(close)', 20)} AS MA_20, {_RETURN_SQL} AS Return FROM bars {_W}) "
    f"{_select(['close', 'volume', 'MA_20', 'Return'], 'x', 4)}",
)
def joined(spark, d):
    bars = inputs.bars(spark, d)
    extra = ind.returns(ind.sma(bars, [20])).select("ticker", "date", "MA_20", "Return")
    return _shown(bars_with_indicators(bars, extra), ["close", "volume", "MA_20", "Return"], 4)


# --- ticks: one key may hold any share of the rows ---------------------------------------------------------

_TICK_W = "WINDOW w AS (PARTITION BY symbol ORDER BY timestamp, seq)"
_TICK_FRAME = "(PARTITION BY symbol ORDER BY timestamp, seq ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


@query(
    "tick_ema",
    f"WITH {inputs.TICKS} SELECT symbol, seq, "
    + ", ".join(
        rounded_sql(_ema_sql("price", f"(2.0::DOUBLE / {n + 1})", "symbol", "timestamp, seq"), 6, f"EMA_{n}") for n in (12, 200)
    )
    + " FROM ticks",
)
def tick_ema(spark, d):
    wanted = {f"EMA_{n}": (F.col("price"), ind.span_alpha(n)) for n in (12, 200)}
    out = ema_any_size(inputs.ticks(spark, d), wanted, TICKS)
    return out.select("symbol", "seq", rounded("EMA_12"), rounded("EMA_200"))


@query(
    "tick_window_stats",
    f"""WITH {inputs.TICKS} SELECT symbol, seq, {rounded_sql(f"avg(price) OVER {_TICK_FRAME}", 5, "MA_20")},
  {rounded_sql(f"stddev_samp(price) OVER {_TICK_FRAME}", 5, "SD_20")}, min(price) OVER {_TICK_FRAME} AS MIN_20,
  max(price) OVER {_TICK_FRAME} AS MAX_20,
  {rounded_sql("(price - lag(price) OVER w) / nullif(lag(price) OVER w, 0)", 6, "Return")} FROM ticks {_TICK_W}""",
)
def tick_window_stats(spark, d):
    out = ind.tick_indicators(inputs.ticks(spark, d), TICKS)
    return out.select("symbol", "seq", rounded("MA_20", 5), rounded("SD_20", 5), "MIN_20", "MAX_20", rounded("Return"))


@query(
    "tick_running_vwap",
    f"""WITH {inputs.TICKS}, x AS (SELECT symbol, seq, sum(price * volume) OVER r AS traded, sum(volume) OVER r AS shares
  FROM ticks WINDOW r AS (PARTITION BY symbol ORDER BY timestamp, seq ROWS UNBOUNDED PRECEDING))
SELECT symbol, seq, shares, {rounded_sql("traded / nullif(shares, 0)", 5, "VWAP")} FROM x""",
)
def tick_running_vwap(spark, d):
    totals = {"traded": F.col("price") * F.col("volume"), "shares": F.col("volume")}
    out = running_total(inputs.ticks(spark, d), totals, TICKS)
    return out.select("symbol", "seq", "shares", rounded(F.try_divide("traded", "shares"), 5, "VWAP"))


@query(
    "tick_obv",
    f"""WITH {inputs.TICKS}, s AS (SELECT *, coalesce(sign(price - lag(price) OVER w), 0) * volume AS sv FROM ticks {_TICK_W})
SELECT symbol, seq, sum(sv) OVER (PARTITION BY symbol ORDER BY timestamp, seq ROWS UNBOUNDED PRECEDING) + 0.0 AS OBV FROM s""",
)
def tick_obv(spark, d):
    ticks = inputs.ticks(spark, d)
    parts, blocked = split(ticks, TICKS, halo=1)
    move = F.signum(F.col("price") - F.lag("price").over(blocked.window()))
    signed = main_rows(parts.withColumn("signed", F.coalesce(move, F.lit(0.0)) * F.col("volume")))
    out = running_total(signed, {"OBV": F.col("signed")}, TICKS)
    return out.select("symbol", "seq", (F.col("OBV") + F.lit(0.0)).alias("OBV"))
