"""Describe tables: columns, keys, distinct shares, previews."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from candlewick.functions.numeric import ratio

_COLUMNS = T.StructType(
    [
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
    ]
)


def uniqueness(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """``column_name, distinct_ratio``: distinct over non-null values of each column, all in one scan.

    NULL for a column without values. ``approximate`` swaps exact distinct counts for sketches, which keeps very
    wide tables from expanding every row once per column.
    """
    columns = list(columns or df.columns)
    count = F.approx_count_distinct if approximate else F.count_distinct
    shares = df.agg(*[ratio(count(F.col(c)), F.count(F.col(c))).alias(c) for c in columns])
    return _long(shares, columns, "distinct_ratio")


def _long(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias(value)) for c in columns])
    return one_row.select(F.inline(pairs))


#: Size of a sketch (2**14 counters, about 13 kB) and its relative error; estimates further than five errors from a threshold decide by themselves.
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def _sketchable(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return value
    return value.cast("string") if isinstance(field.dataType, T.AtomicType) else F.to_json(F.struct(value))


def column_sketches(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``column_name``, ``data_type``, ``rows``, ``values`` and ``sketch`` of each column, per group if ``by`` names any: one scan, no row twice.

    Sketches are worth storing, for instance one per day's partition: those of old partitions never change, and ``united`` merges any
    number of them. Each task sends one sketch per column and group. Columns that are all NULL have an empty sketch.
    """
    fields = [f for f in df.schema.fields if f.name not in by]
    stats = []
    for i, field in enumerate(fields):
        value = _sketchable(field)
        count = F.count(value).alias("values")
        stats.append(F.struct(F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("data_type"), F.count(F.lit(1)).alias("rows"), count, F.hll_sketch_agg(value, SKETCH_BITS).alias("sketch")).alias(f"c{i}"))
    grouped = df.groupBy(*by).agg(*stats)
    return grouped.select(*by, F.inline(F.array(*[F.col(f"c{i}") for i in range(len(fields))])))


def united(sketches: DataFrame) -> DataFrame:
    """``column_name``, ``data_type``, ``rows``, ``null_count``, ``distinct_estimate`` and ``distinct_ratio`` over all groups of stored sketches."""
    whole = sketches.groupBy("column_name", "data_type").agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate")
    )
    estimate = F.least("distinct_estimate", "values")
    return whole.select("column_name", "data_type", "rows", (F.col("rows") - F.col("values")).alias("null_count"), estimate.alias("distinct_estimate"), ratio(estimate, F.col("values")).alias("distinct_ratio"))


def key_candidates(df: DataFrame, threshold: float = 0.99, approximate: bool = False, sketches: DataFrame | None = None) -> DataFrame:
    """Columns whose distinct share reaches the threshold, with the share.

    Sketches, stored ones or those of one scan, decide for the columns clearly above or below; only columns near the threshold are counted exactly, one at a time.
    The share of a column clearly above is an estimate. ``approximate`` takes all estimates as they are. A row per column reaches
    the driver.
    """
    found = united(column_sketches(df) if sketches is None else sketches).select("column_name", "distinct_ratio").filter("distinct_ratio is not null")
    if approximate:
        return found.filter(F.col("distinct_ratio") >= threshold)
    rows = [r for r in found.collect() if r["column_name"] in df.columns]
    near = [r["column_name"] for r in rows if abs(r["distinct_ratio"] - threshold) <= 5 * SKETCH_ERROR]
    sure = [(r["column_name"], r["distinct_ratio"]) for r in rows if r["column_name"] not in near and r["distinct_ratio"] >= threshold]
    out = df.sparkSession.createDataFrame(sure, "column_name string, distinct_ratio double")
    for column in near:  # each on its own: several distinct counts at once would copy every row
        out = out.unionByName(uniqueness(df, [column]).filter(F.col("distinct_ratio") >= threshold))
    return out


def profile(df: DataFrame) -> DataFrame:
    """Type, null count and distinct count of every column, from one scan."""
    stats = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.count_if(F.col(f"`{field.name}`").isNull()).alias("null_count"),
            F.count_distinct(F.col(f"`{field.name}`")).alias("distinct_count"),
        ).alias(f"c{i}")
        for i, field in enumerate(df.schema.fields)
    ]
    one_row = df.agg(*stats)
    return one_row.select(F.inline(F.array(*[F.col(c) for c in one_row.columns])))


def columns_of(df: DataFrame) -> DataFrame:
    """``column_name, data_type`` rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, _COLUMNS)


@dataclass(frozen=True)
class Preview:
    """First rows of a table, its columns and how many rows are shown."""

    columns: list[str]
    rows: DataFrame
    row_count: int


def preview(df: DataFrame, rows: int = 15) -> Preview:
    head = df.limit(rows)
    return Preview(df.columns, head, head.count())


def dataset_info(df: DataFrame, features: Sequence[str], date: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Sample count, date range and the feature columns present."""
    present = [c for c in features if c in df.columns]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.lit(len(present)).alias("n_features"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.lit(",".join(present)).alias("feature_cols"),
    )


def table_list(spark: SparkSession, hidden: Sequence[str] = ("information_schema",)) -> DataFrame:
    """``schema_name, table_name`` of the session catalog, without hidden schemas."""
    rows = [
        (schema.name, table.name)
        for schema in spark.catalog.listDatabases()
        if schema.name not in hidden
        for table in spark.catalog.listTables(schema.name)
        if not table.isTemporary
    ]
    return spark.createDataFrame(rows, "schema_name string, table_name string")


def tables_per_schema(tables: DataFrame) -> DataFrame:
    """Sorted table names and their number per schema."""
    return tables.groupBy("schema_name").agg(
        F.sort_array(F.collect_list("table_name")).alias("tables"), F.count(F.lit(1)).alias("table_count")
    )


def declared_keys(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """Primary-key columns from the two catalog tables that describe constraints."""
    on = ["constraint_name", "table_schema"]
    primary = constraints.filter(F.col("constraint_type") == "PRIMARY KEY").select(*on, "table_name")
    return primary.join(usage.select(*on, "column_name"), on).select("table_schema", "table_name", "column_name")


def keys_of(df: DataFrame, declared: DataFrame | None = None, threshold: float = 0.99) -> DataFrame:
    """``column_name``, ``source``: the declared key columns, else those detected from the data."""
    if declared is not None and not declared.isEmpty():
        return declared.select("column_name", F.lit("declared").alias("source"))
    return key_candidates(df, threshold).select("column_name", F.lit("detected").alias("source"))


def primary_keys(df: DataFrame, declared: Sequence[str] = (), threshold: float = 0.99) -> list[str]:
    """The declared keys, else the detected ones."""
    if declared:
        return list(declared)
    return [row["column_name"] for row in key_candidates(df, threshold).collect()]
