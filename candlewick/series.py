"""Ordered series per key, whole or split in blocks.

A daily series holds one row per key and date, so the calendar bounds it (36,525 rows in a century)
and ``Window.partitionBy(key)`` is safe. A tick series has no such bound: one symbol may hold a third of
all rows. ``split`` cuts such a series into blocks of consecutive cells, each block with the
trailing rows its frames need, so that every operator written against ``Series`` runs on many tasks per key.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from candlewick.session import shared_dir, staged

GROUP = "_group"  # struct of key and block: one column, so that a join and the windows after it share a shuffle
BLOCK = "_block"
MAIN = "_main"
BEFORE = "_before"
ON = "_on"


@dataclass(frozen=True)
class Series:
    """Names of the key and order columns; ``blocked`` series also partition by block."""

    key: tuple[str, ...] = ("ticker",)
    order: tuple[str, ...] = ("date",)
    blocked: bool = False

    @property
    def partition(self) -> list[str]:
        return [GROUP] if self.blocked else list(self.key)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.partition).orderBy(*self.order)

    def trailing(self, rows: int) -> WindowSpec:
        """The last ``rows`` rows including the current one."""
        return self.window().rowsBetween(-rows + 1, 0)

    def running(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, 0)

    def newest_first(self) -> WindowSpec:
        return Window.partitionBy(*self.partition).orderBy(*[F.col(c).desc() for c in self.order])


DAILY = Series()
TICKS = Series(key=("symbol",), order=("timestamp", "seq"))


#: Rows of whole keys that a task takes; it holds them several times over in wide rows while windows sort them.
TASK_ROWS = 200_000


def in_tasks(df: DataFrame, on: Sequence[str], rows: int, task_rows: int | None = None) -> DataFrame:
    """``df``, of so many rows, dealt by ``on`` to as many tasks as hold about ``TASK_ROWS`` each.

    Spark joins shuffle partitions up to 64 MB of narrow, compressed rows. Windows make them twenty times as wide and sort them again and
    again, so that a task would grow with the table. A small table is left to Spark.
    """
    tasks = tasks_of(df, rows, task_rows)
    return df if tasks <= 1 else df.repartition(tasks, *on)


def tasks_of(df: DataFrame, rows: int, task_rows: int | None = None) -> int:
    tasks = -(-rows // (task_rows or TASK_ROWS))
    return tasks if tasks <= 1 else max(tasks, df.sparkSession.sparkContext.defaultParallelism)


def staged_in_tasks(df: DataFrame, on: Sequence[str], tasks: int, purpose: str) -> DataFrame:
    """As ``staged``, in files of so many tasks by ``on``. Spark knows how the rows are dealt, so that windows and joins by ``on`` read
    them without a shuffle, however often. Rows that lie in that many tasks already, or a multiple, should not be dealt to others before:
    each task then writes one file. The table's name is dropped at once; its files stay, and the rows are read by path.
    """
    if tasks <= 1:
        return staged(df, purpose)
    spark, name = df.sparkSession, f"spark_catalog.default.{purpose}_{uuid.uuid4().hex}"
    df.write.bucketBy(tasks, *on).format("parquet").option("path", shared_dir(spark, purpose)).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def attach(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns where NULL finds NULL, so that rows with NULL keys find their group too."""
    keyed = right.select(F.struct(*on).alias(ON), *[c for c in right.columns if c not in on])
    return left.withColumn(ON, F.struct(*on)).join(keyed, ON, how).drop(ON)


def bucket_sizes(df: DataFrame, series: Series, bucket: str, **sums: Column) -> DataFrame:
    """Rows (and sums) per key and bucket, with the running totals before each bucket.

    Aggregates map-side; the window then sees one row per bucket, not per input row.
    """
    totals = {"_n": F.count(F.lit(1)), **{name: F.sum(value) for name, value in sums.items()}}
    sizes = df.groupBy(*series.key, bucket).agg(*[agg.alias(name) for name, agg in totals.items()])
    earlier = (
        Window.partitionBy(*series.key)
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    running = [
        F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(BEFORE if name == "_n" else f"{name}_before")
        for name in totals
    ]
    return sizes.select(*series.key, bucket, "_n", *running)


#: Width of the first cells by kind of order column: 2**30 microseconds (18 minutes), 64 days, 4,096 units.
_CELL_BITS = {"timestamp": 30, "date": 6, "number": 12}
_NEAR = 10  # 2**10 first cells make a stretch, so that running totals never see a whole key at once
CELL = "_cell"


def _numbers(df: DataFrame, series: Series) -> list[tuple[Column, int]]:
    """The leading order columns as numbers, with the bits of their first cells; a column of another type ends the list."""
    out = []
    for column in series.order:
        kind = df.schema[column].dataType
        if isinstance(kind, T.DateType):
            out.append((F.unix_date(column).cast("long"), _CELL_BITS["date"]))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            out.append((F.unix_micros(F.col(column).cast("timestamp")), _CELL_BITS["timestamp"]))
        elif isinstance(kind, T.NumericType):
            whole = isinstance(kind, T.IntegralType)
            out.append((F.col(column).cast("long" if whole else "double"), _CELL_BITS["number"]))
        else:
            break
    return out


def _histogram(rows: DataFrame, key: Sequence[str], at: list[Column], sums: Mapping[str, Column], most: int) -> DataFrame:
    """Rows per cell (and sums), and how to cut a cell of more than ``most`` rows: ``_by`` says along which order column."""
    n = F.count(F.lit(1))
    seen = [(F.count(x), F.min(x).cast("double"), F.max(x).cast("double")) for x in at]
    measured = [c.alias(f"_{name}{i}") for i, three in enumerate(seen) for name, c in zip(("some", "low", "high"), three, strict=True)]
    totals = [F.sum(value).alias(name) for name, value in sums.items()]
    cells = rows.groupBy(*key, CELL).agg(n.alias("_n"), *measured, *totals)
    by, low, high = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for i in reversed(range(len(at))):  # the first column that differs; those before it are equal, so the order holds
        flat = (F.col(f"_some{i}") == 0) | ((F.col(f"_some{i}") == F.col("_n")) & (F.col(f"_low{i}") == F.col(f"_high{i}")))
        by, low, high = (F.when(~flat, x).otherwise(y) for x, y in ((F.lit(i), by), (F.col(f"_low{i}"), low), (F.col(f"_high{i}"), high)))
    by = F.when(F.col("_n") > most, by)
    width = (high - low) / F.ceil(F.col("_n") / most)
    return cells.select(*key, CELL, "_n", *sums, by.alias("_by"), low.alias("_low"), width.alias("_width"))


def celled(
    df: DataFrame, series: Series, bucket: Column | None = None, rows: int = 4096, sums: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``df`` with its ``_cell``, and the table of cells: rows and sums in each. No cell holds more than about ``rows`` rows.

    A cell is a path of slots. The first are fixed stretches of the first order column, or ``bucket``; one scan counts them. A cell with too
    many rows is cut along its own span into slots of ``rows`` rows if they lay evenly, at one instant along the next order column,
    and so on until all hold few enough: each turn scans the narrow columns of the crowded cells only. Outliers
    and bursts so cost nothing elsewhere. Rows that are equal in all numeric order columns have no order to cut, and stay in one cell.
    """
    sums = dict(sums or {})
    numbered = _numbers(df, series)
    at = [x for x, _ in numbered]
    if bucket is None and not numbered:
        raise ValueError("the first order column must be a number, a date or a timestamp")
    bits = numbered[0][1] if numbered else 0
    first = bucket if bucket is not None else (F.shiftright(F.floor(at[0]).cast("long"), bits) if bits else at[0])
    placed = df.withColumn(CELL, F.struct(first.alias("_0")))
    narrow = placed.select(*series.key, CELL, *series.order, *[v.alias(n) for n, v in sums.items()])
    key, done, level, depth = list(series.key), [], narrow, 0
    while True:
        cells = staged(_histogram(level, key, at, {n: F.col(n) for n in sums}, rows), "cells")
        done.append(cells.filter("_by is null").select(*key, CELL, "_n", *sums))
        crowded = cells.filter("_by is not null").select(*key, CELL, "_by", "_low", "_width")
        if crowded.isEmpty():
            break
        depth += 1
        names = [f"_{i}" for i in range(depth)]
        value = F.coalesce(*[F.when(F.col("_by") == i, x.cast("double")) for i, x in enumerate(at)])
        slot = F.when(F.col("_width") > 0, F.floor((value - F.col("_low")) / F.col("_width"))).otherwise(F.when(value.isNotNull(), F.lit(0)))
        path = F.struct(*[F.col(f"{CELL}.{n}").alias(n) for n in names], F.when(F.col("_by").isNotNull(), slot).cast("long").alias(f"_{depth}"))
        longer = lambda frame, how: attach(frame, crowded, [*key, CELL], how).withColumn(CELL, path).drop("_by", "_low", "_width")
        placed, level = longer(placed, "left"), longer(level, "inner")
    full = [f"_{i}" for i in range(depth + 1)]
    filled = []
    for k, cells in enumerate(done):
        path = F.struct(*[(F.col(f"{CELL}.{n}") if i <= k else F.lit(None).cast("long")).alias(n) for i, n in enumerate(full)])
        filled.append(cells.withColumn(CELL, path))
    return placed, reduce(DataFrame.unionByName, filled)


def cell_sizes(cells: DataFrame, series: Series, sums: Sequence[str] = ()) -> DataFrame:
    """The cells with the totals before each (``_before``, ``<sum>_before``) and the ``_total`` rows of the key.

    Totals run over stretches of cells, then inside each stretch.
    """
    names = {"_n": BEFORE, **{name: f"{name}_before" for name in sums}}
    kind = cells.schema[CELL].dataType["_0"].dataType
    near = F.shiftright(F.col(f"{CELL}._0"), _NEAR) if isinstance(kind, T.LongType) else F.lit(0)
    placed = cells.withColumn("_far", near)
    far = placed.groupBy(*series.key, "_far").agg(*[F.sum(n).alias(n) for n in names])
    whole = Window.partitionBy(*series.key)
    earlier = whole.orderBy("_far").rowsBetween(Window.unboundedPreceding, -1)
    far = far.select(*series.key, "_far", F.sum("_n").over(whole).alias("_total"), *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_far{n}") for n in names])
    joined = attach(placed, far, [*series.key, "_far"])
    inside = Window.partitionBy(*series.key, "_far").orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    running = [(F.col(f"_far{n}") + F.coalesce(F.sum(n).over(inside), F.lit(0))).alias(out) for n, out in names.items()]
    return joined.select(*series.key, CELL, "_n", "_total", *running)


def split(
    df: DataFrame,
    series: Series,
    bucket: Column | None = None,
    halo: int = 0,
    block_rows: int = 65536,
) -> tuple[DataFrame, Series]:
    """Cut each key into blocks of about ``block_rows`` rows, at most two and a quarter times as many with a halo.

    A block is a run of whole cells (see ``celled``), cells of at most a quarter of a block, whatever the density: outliers, bursts and many rows at
    one instant, if a further order column tells them apart. A ``bucket`` of your own, such as a truncated timestamp, replaces the first cells; it must not
    decrease along the series order. Every block also receives at least the ``halo`` rows before it (all, if there are fewer),
    marked ``_main = false``; drop them with ``main_rows`` once the trailing frames are computed. Keys of one block meet no table of cells.
    """
    if halo > block_rows:
        raise ValueError("halo must not exceed block_rows")
    placed, cells = celled(df, series, bucket, max(1, min(4096, block_rows // 4)))
    sizes = cell_sizes(cells, series).filter(F.col("_total") > block_rows)
    end = F.col(BEFORE) + F.col("_n")
    own = F.floor(F.col(BEFORE) / block_rows)
    targets = F.array(own)
    if halo:
        # Blocks that start within ``halo`` rows after this cell: at most two, since halo <= block_rows.
        targets = F.array_distinct(
            F.array(own, F.floor(end / block_rows), F.floor((end + halo - 1) / block_rows))
        )
    exploded = sizes.select(*series.key, CELL, own.alias("_own"), F.explode(targets).alias(BLOCK))
    marked = exploded.select(*series.key, CELL, BLOCK, (F.col(BLOCK) == F.col("_own")).alias(MAIN))
    joined = attach(placed, marked, [*series.key, CELL], "left")
    block, main = F.coalesce(BLOCK, F.lit(0)).cast("long").alias(BLOCK), F.coalesce(MAIN, F.lit(True)).alias(MAIN)
    return joined.select(*df.columns, F.struct(*series.key, block).alias(GROUP), main), replace(series, blocked=True)


def main_rows(df: DataFrame) -> DataFrame:
    """Rows of the blocks themselves, without the halo copies."""
    return df.filter(MAIN).drop(GROUP, MAIN)


def running_total(
    df: DataFrame, values: dict[str, Column], series: Series, bucket: Column | None = None, rows: int = 65536
) -> DataFrame:
    """Running sums of a series of any size: sum inside the cell plus the sum of the cells before.

    Cells hold about ``rows`` rows at most, however densely they lie (see ``celled``).
    """
    names = {f"_sum_{i}": value for i, value in enumerate(values.values())}
    placed, cells = celled(df, series, bucket, rows, names)
    earlier = cell_sizes(cells, series, list(names)).select(F.struct(*series.key, CELL).alias(ON), *[f"{name}_before" for name in names])
    joined = placed.select("*", F.struct(*series.key, CELL).alias(ON)).join(earlier, ON)
    inside = Window.partitionBy(ON).orderBy(*series.order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *df.columns,
        *[
            (F.col(f"{name}_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))).alias(out)
            for out, (name, value) in zip(values, names.items(), strict=True)
        ],
    )
