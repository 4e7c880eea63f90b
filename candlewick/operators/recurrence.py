"""Exponential averages over rows with gaps: ``e = (w e' + a x) / (w + a)`` with ``w = (1-a)^steps`` since the last value.

Without gaps this is ``(1-a) e' + a x``. A missing value leaves the average as it is, and its weight decays on. Each row so is an affine map of
the average before; maps compose, so a run of rows is one factor and one offset. Inside a chunk of consecutive rows the offset is a running
sum scaled by the factors, whose logarithm stays far from overflow. Chunks, and blocks of a long series, then chain their maps; the factor of a block shrinks with
each value in it, so that only a bounded run of earlier blocks is ever looked at.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.series import BLOCK, DAILY, GROUP, MAIN, Series, split

_SCALE_LIMIT = 300.0  # of a chunk, and of the gap before its first value: exp(600) is about 1e260
_UNDERFLOW = 750.0  # exp(-750) is zero as a double
_ROW = "_row"


def _decay(alpha: float) -> float:
    return -math.log1p(-alpha)


def chunk_rows(alphas: list[float]) -> int:
    """Longest chunk whose scale stays finite for every alpha."""
    if any(not 0.0 < a < 1.0 for a in alphas):
        raise ValueError("every alpha must lie between 0 and 1")
    return max(1, int(_SCALE_LIMIT / max(_decay(a) for a in alphas)))


def reach_rows(alpha: float) -> int:
    """Values after which a carried one has decayed to exactly zero, with or without gaps between them."""
    return math.ceil(_UNDERFLOW / _decay(alpha))


def ema_inputs(series: Series) -> list[Column]:
    """Row number from 0, taken along with other columns of the same window."""
    return [(F.row_number().over(series.window()) - 1).alias(_ROW)]


def _weight(alpha: float, steps: Column) -> Column:
    return F.pow(F.lit(1 - alpha), steps)


def _mapped(
    df: DataFrame, wanted: Mapping[str, tuple[Column, float]], series: Series, seeded: bool
) -> tuple[DataFrame, dict[str, int]]:
    """Per average the map of all rows of the partition up to this one: ``_factor_<name>``, ``_offset_<name>``; per distinct input the
    number ``_last<i>`` of the last row with a value. The second result tells which input an average has.

    The first value of the partition is the seed: it enters as offset if ``seeded``, else the map starts behind it.
    """
    numbered = df if _ROW in df.columns else df.select("*", *ema_inputs(series))
    size = chunk_rows([alpha for _, alpha in wanted.values()])
    inputs: dict[str, int] = {}
    of = {name: inputs.setdefault(str(value), len(inputs)) for name, (value, _) in wanted.items()}
    values = {of[name]: value.cast("double") for name, (value, _) in wanted.items()}
    row, offset = F.col(_ROW), F.col("_offset")
    here = {i: F.when(value.isNotNull(), row) for i, value in values.items()}
    before = [F.max(x).over(series.running().rowsBetween(Window.unboundedPreceding, -1)).alias(f"_prev{i}") for i, x in here.items()]
    chunked = numbered.select("*", F.floor(row / size).alias("_chunk"), (row % size).alias("_offset"), *before)
    inside = Window.partitionBy(*series.partition, "_chunk").orderBy(*series.order).rowsBetween(Window.unboundedPreceding, 0)
    steps = {i: row - F.col(f"_prev{i}") for i in values}
    most = {name: math.floor(_SCALE_LIMIT / _decay(alpha)) for name, (_, alpha) in wanted.items()}

    def gap(name: str, alpha: float) -> Column:
        """Of a value behind a gap: by how much its factor exceeds the plain decay. A value without a gap adds nothing."""
        capped = F.least(steps[of[name]], F.lit(most[name]))
        return F.when(here[of[name]].isNotNull() & (steps[of[name]] > 1), F.log(_weight(alpha, capped) + alpha))

    found = [F.max(x).over(inside).alias(f"_here{i}") for i, x in here.items()]
    found += [F.min(x).over(inside).alias(f"_first{i}") for i, x in here.items()]
    found += [F.min(F.when(x.isNotNull(), F.coalesce(f"_prev{i}", x))).over(inside).alias(f"_from{i}") for i, x in here.items()]
    found += [F.coalesce(F.sum(gap(name, alpha)).over(inside), F.lit(0.0)).alias(f"_gap_{name}") for name, (_, alpha) in wanted.items()]
    placed = chunked.select("*", *found)

    def scale(name: str, alpha: float) -> Column:
        """Logarithm of the factor from the chunk's start; a gap so long that its weight is nothing beside the value counts as the longest."""
        i = of[name]
        start = F.greatest(F.col(f"_from{i}"), F.col(f"_first{i}") - most[name])
        return F.coalesce(-_decay(alpha) * (F.col(f"_here{i}") - start) - F.col(f"_gap_{name}"), F.lit(0.0))

    scaled = placed.select("*", *[scale(name, alpha).alias(f"_scale_{name}") for name, (_, alpha) in wanted.items()])

    def added(name: str, alpha: float) -> Column:
        value, prev = values[of[name]], F.col(f"_prev{of[name]}")
        capped = F.least(steps[of[name]], F.lit(most[name]))
        share = F.when(prev.isNull(), F.lit(1.0 if seeded else 0.0)).when(steps[of[name]] == 1, F.lit(alpha)).otherwise(alpha / (_weight(alpha, capped) + alpha))
        return F.coalesce(value * share, F.lit(0.0)) * F.exp(-F.col(f"_scale_{name}"))

    local = scaled.select(
        "*",
        *[(F.sum(added(name, alpha)).over(inside) * F.exp(f"_scale_{name}")).alias(f"_local_{name}") for name, (_, alpha) in wanted.items()],
        *[F.coalesce(f"_here{i}", f"_prev{i}").alias(f"_last{i}") for i in values],
    )
    # One list of chunk ends for all averages; shorter than one entry per ``size`` rows.
    # Same sort order as ``inside``, so the second window needs no further sort.
    earlier = (
        Window.partitionBy(*series.partition)
        .orderBy("_chunk", *series.order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ends = F.struct(*[F.struct(F.exp(f"_scale_{name}").alias("f"), F.col(f"_local_{name}").alias("o")).alias(name) for name in wanted])
    ended = local.select("*", F.collect_list(F.when(offset == size - 1, ends)).over(earlier).alias("_ends"))

    def chained(name: str) -> Column:
        carry = F.aggregate("_ends", F.lit(0.0), lambda acc, end: acc * end[name]["f"] + end[name]["o"])
        return (F.col(f"_local_{name}") + F.exp(f"_scale_{name}") * carry).alias(f"_offset_{name}")

    def factor(name: str) -> Column:
        return (F.aggregate("_ends", F.exp(f"_scale_{name}"), lambda acc, end: acc * end[name]["f"])).alias(f"_factor_{name}")

    lasts = [f"_last{i}" for i in values]
    factors = [] if seeded else [factor(name) for name in wanted]
    return ended.select(*numbered.columns, *lasts, *factors, *[chained(name) for name in wanted]), of


def carried_ema(df: DataFrame, wanted: Mapping[str, tuple[Column, float]], series: Series = DAILY) -> DataFrame:
    """Add one column per entry ``name -> (value, alpha)``, seeded with the first value of each partition.

    NULL until there is a value; a NULL value later repeats the average, and weighs the next value as if it had decayed on.
    """
    mapped, of = _mapped(df, wanted, series, seeded=True)
    keep = [c for c in df.columns if c != _ROW]
    return mapped.select(*keep, *[F.when(F.col(f"_last{of[name]}").isNotNull(), F.col(f"_offset_{name}")).alias(name) for name in wanted])


def ema_any_size(
    df: DataFrame,
    wanted: dict[str, tuple[Column, float]],
    series: Series,
    bucket: Column | None = None,
    block_rows: int = 65536,
) -> DataFrame:
    """The same averages for a series of any size (ticks)."""
    parts, blocked = split(df, series, bucket, block_rows=block_rows)
    return over_blocks(parts.drop(MAIN), blocked, wanted).select(*df.columns, *wanted)


def over_blocks(
    blocks: DataFrame,
    series: Series,
    averages: dict[str, tuple[Column, float]],
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Recursive averages and running totals of a blocked series, without halo rows.

    Each block yields one row: its totals, its first value, and the map of the average from there to its end. The block's
    first value meets the state before it with the gap that lies between, which earlier blocks know. States chain
    the maps of the blocks as long as a carry lives. Blocks keep their place, so adding the state needs no further
    shuffle of the rows.
    """
    totals = totals or {}
    key = [f"_key_{i}" for i in range(len(series.key))]
    sums = [F.sum(value).over(series.running()).alias(name) for name, value in totals.items()]
    inside, of = _mapped(blocks.select("*", *ema_inputs(series), *sums), averages, series, seeded=False)
    values = {of[name]: value.cast("double") for name, (value, _) in averages.items()}

    ends = inside.groupBy(GROUP).agg(
        (F.max(_ROW) + 1).alias("_len"),
        *[F.max_by(name, _ROW).alias(f"_end_{name}") for name in totals],
        *[F.max_by(f"_{part}_{name}", _ROW).alias(f"_{part}_{name}") for name in averages for part in ("factor", "offset")],
        *[agg for i, v in values.items() for agg in (
            F.min(F.when(v.isNotNull(), F.col(_ROW))).alias(f"_first{i}"),
            F.min_by(v, F.when(v.isNotNull(), F.col(_ROW))).alias(f"_value{i}"),
            F.max(f"_last{i}").alias(f"_last{i}"),
            F.count(v).alias(f"_count{i}"),
        )],
    )
    keyed = ends.select("*", *[F.col(GROUP)[k].alias(name) for name, k in zip(key, series.key, strict=True)])
    by_key = Window.partitionBy(*key).orderBy(F.col(GROUP)[BLOCK])
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.select("*", F.coalesce(F.sum("_len").over(earlier), F.lit(0)).alias("_start"))
    gaps = placed.select(
        "*",
        *[F.max(F.col("_start") + F.col(f"_last{i}")).over(earlier).alias(f"_prev{i}") for i in values],
        *[F.sum(f"_count{i}").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_seen{i}") for i in values],
    )

    def weight(name: str, alpha: float) -> Column:
        i = of[name]
        return _weight(alpha, F.col("_start") + F.col(f"_first{i}") - F.col(f"_prev{i}"))

    def block_map(name: str, alpha: float) -> Column:
        """Factor and offset of a whole block, from the state before it; nothing for a block without values."""
        i, w = of[name], weight(name, alpha)
        known = F.col(f"_prev{i}").isNotNull()
        factor, offset, value = F.col(f"_factor_{name}"), F.col(f"_offset_{name}"), F.col(f"_value{i}")
        f = F.when(known, factor * w / (w + alpha)).otherwise(F.lit(0.0))
        o = offset + factor * value * F.when(known, alpha / (w + alpha)).otherwise(F.lit(1.0))
        return F.when(F.col(f"_count{i}") > 0, F.struct(f.alias("f"), o.alias("o"))).alias(f"_map_{name}")

    maps = gaps.select("*", *[block_map(name, alpha) for name, (_, alpha) in averages.items()])

    def live(name: str, alpha: float) -> Column:
        # Blocks without values add no map to the list. Those of one count of values seen are one block with values and those after it.
        frame = Window.partitionBy(*key).orderBy(f"_seen{of[name]}").rangeBetween(-reach_rows(alpha), 0)
        return F.collect_list(f"_map_{name}").over(frame).alias(f"_live_{name}")

    def state(name: str) -> Column:
        chain = F.aggregate(f"_live_{name}", F.lit(0.0), lambda acc, m: acc * m["f"] + m["o"])
        return F.when(F.col(f"_seen{of[name]}") > 0, chain).alias(f"_state_{name}")

    carries = maps.select("*", *[live(name, alpha) for name, (_, alpha) in averages.items()])
    states = carries.select("*", *[state(name) for name in averages])
    # A block starts from the state at the end of the block before it.
    held = states.select("*", *[F.lag(f"_state_{name}").over(by_key).alias(f"_held_{name}") for name in averages])

    def first(name: str, alpha: float) -> Column:
        """The average at the block's first value."""
        i, w, before = of[name], weight(name, alpha), F.col(f"_held_{name}")
        return F.when(before.isNull(), F.col(f"_value{i}")).otherwise((w * before + alpha * F.col(f"_value{i}")) / (w + alpha)).alias(f"_at_{name}")

    starts = held.select(
        GROUP,
        *[F.col(f"_first{i}").alias(f"_opens{i}") for i in values],
        *[c for name, (_, alpha) in averages.items() for c in (F.col(f"_held_{name}"), first(name, alpha))],
        *[F.coalesce(F.sum(f"_end_{name}").over(earlier), F.lit(0)).alias(f"_start_{name}") for name in totals],
    )
    joined = inside.join(starts, GROUP)

    def finished(name: str) -> Column:
        i = of[name]
        reached = F.col(_ROW) >= F.col(f"_opens{i}")
        return F.when(reached, F.col(f"_offset_{name}") + F.col(f"_factor_{name}") * F.col(f"_at_{name}")).otherwise(F.col(f"_held_{name}")).alias(name)

    return joined.select(
        *blocks.columns,
        *[finished(name) for name in averages],
        *[(F.coalesce(F.col(name), F.lit(0)) + F.col(f"_start_{name}")).alias(name) for name in totals],
    )
