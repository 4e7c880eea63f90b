"""Layered tables: bronze, silver, gold databases with overwrite, append and keyed upsert."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.functions.numeric import all_of

LAYERS = ("bronze", "silver", "gold")
MODES = ("overwrite", "append", "merge")
ROW_LEVEL_FORMATS = ("iceberg", "delta")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def valid_name(name: str) -> str:
    """The trimmed name, if it is a plain identifier."""
    cleaned = (name or "").strip()
    if not _NAME.fullmatch(cleaned):
        raise ValueError(f"not a valid table or layer name: {name!r}")
    return cleaned


class DuplicateKeys(ValueError):
    """The source of an upsert holds a key more than once."""


def merge_statement(target: str, source: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """MERGE for tables that support row-level changes."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (
        f"MERGE INTO {target} t USING {source} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice. Keys with a NULL never match anything and may repeat."""
    repeated = df.select(*keys).na.drop("any").groupBy(*keys).count().filter("count > 1")
    found = repeated.limit(5).collect()
    if found:
        raise DuplicateKeys(f"duplicate source keys, for instance {[tuple(r)[:-1] for r in found]}")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after an upsert: matched rows take every source column, the others are added.

    Target columns that the source lacks keep their value on matched rows.
    """
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"columns not in the target table: {extra}")
    keys = list(keys)
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        source = source.join(target.select(*keys, *missing), keys, "left")
    untouched = target.join(source.select(*keys), keys, "left_anti")
    return untouched.select(*target.columns).unionByName(source.select(*target.columns))


def without(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(gone.select(*keys), list(keys), "left_anti").select(*target.columns)


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one output partition together, large ones split again by AQE: few files, no hot task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


@contextmanager
def _dynamic_partitions(spark: SparkSession):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Lake:
    """Tables of the layers under one root folder; one writer per table."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", fmt: str = "parquet"):
        self.spark, self.root, self.prefix, self.fmt = spark, root.rstrip("/"), prefix, fmt
        for layer in LAYERS:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}` LOCATION '{self.root}/{layer}'")

    def name(self, table: str) -> str:
        """Catalog name of ``layer.table``."""
        layer, _, rest = table.partition(".")
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}: {table!r}")
        return f"{self.prefix}{layer}.{valid_name(rest)}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def count(self, table: str) -> int:
        """Row count; for parquet it comes from file footers, not from the data."""
        return self.read(table).count()

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def overwrite(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Create or replace. The new rows are complete on disk before the old table goes."""
        if self.exists(table):
            self._replace(df, table, partition_by)
        else:
            self._create(df, self.name(table), partition_by)

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        if not self.exists(table):
            self._create(df, self.name(table), partition_by)
        else:
            columns = self.read(table).columns
            rows = clustered(df.select(*columns), self.partition_columns(table))
            rows.write.insertInto(self.name(table))

    def upsert(
        self,
        df: DataFrame,
        table: str,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        skip_empty: bool = False,
        layout_from_keys: bool = False,
    ) -> None:
        """Update rows with equal keys, insert the others; creates the table on first use.

        The source is computed once, into a staging table that the key check and the merge read. With row-level
        formats the merge is a MERGE. A parquet table partitioned by key columns, or by columns computed from keys
        (``layout_from_keys``), rewrites only the partitions the source touches; any other parquet table is written
        anew and swapped in.
        """
        if not keys:
            raise ValueError("an upsert needs keys")
        name = self.name(table)
        staged = f"{name}__src_{uuid.uuid4().hex[:12]}"
        self._create(df, staged, partition_by if not self.exists(table) else ())
        try:
            source = self.spark.table(staged).select(*df.columns)
            if skip_empty and source.isEmpty():
                return
            check_unique(source, keys)
            if not self.exists(table):
                self._rename(staged, name)
            else:
                self._merge(source, staged, table, keys, layout_from_keys)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {staged}")

    def _merge(self, source: DataFrame, staged: str, table: str, keys: Sequence[str], layout_from_keys: bool) -> None:
        layout = self.partition_columns(table)
        if self.fmt in ROW_LEVEL_FORMATS:
            self.spark.sql(merge_statement(self.name(table), staged, source.columns, keys))
        elif layout and (layout_from_keys or set(layout) <= set(keys)):
            self._merge_partitions(source, table, keys, layout)
        else:
            self._replace(merged(self.read(table), source, keys), table, layout)

    def delete(self, gone: DataFrame, table: str, keys: Sequence[str]) -> None:
        """Remove the rows whose keys occur in ``gone``."""
        self._replace(without(self.read(table), gone, keys), table, self.partition_columns(table))

    def write(
        self, df: DataFrame, table: str, mode: str = "overwrite", keys: Sequence[str] = (), partition_by: Sequence[str] = ()
    ) -> int:
        """Write in the given mode and return the table's row count. The first write always creates."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.recover(table)
        if mode == "merge":
            self.upsert(df, table, keys, partition_by)
        elif mode == "append":
            self.append(df, table, partition_by)
        else:
            self.overwrite(df, table, partition_by)
        return self.count(table)

    def partition_columns(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def view(self, alias: str, table: str) -> DataFrame:
        """Another name for a table."""
        df = self.read(table)
        df.createOrReplaceTempView(valid_name(alias))
        return df

    def recover(self, table: str) -> None:
        """Put back a table whose writer died between the two renames of a swap."""
        layer, short = self.name(table).split(".")
        if not self.spark.catalog.databaseExists(layer) or self.exists(table):
            return
        names = [t.name for t in self.spark.catalog.listTables(layer) if t.name.startswith(f"{short.lower()}__old_")]
        if names:
            self._rename(f"{layer}.{max(names)}", f"{layer}.{short}")

    # --- internals ---

    def _create(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
        writer = clustered(df, partition_by).write.format(self.fmt).mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
        if any(c.isPartition for c in self.spark.catalog.listColumns(new)):
            # Some catalogs keep the old folder in their partition entries.
            self.spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")

    def _replace(self, df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
        """Stage the new rows as a table, then exchange names; a reader never sees half a table."""
        name = self.name(table)
        tag = uuid.uuid4().hex[:12]
        staged, old = f"{name}__new_{tag}", f"{name}__old_{tag}"
        self._create(df, staged, partition_by)
        self._rename(name, old)
        self._rename(staged, name)
        self.spark.sql(f"DROP TABLE {old}")

    def _merge_partitions(self, df: DataFrame, table: str, keys: Sequence[str], layout: list[str]) -> None:
        """Rewrite the partitions that the source touches, NULL ones included. The scan skips what lies outside the source's bounds."""
        target = self.read(table)
        touched = df.select(*layout).distinct()
        ends = [f(c).alias(f"{name}_{c}") for c in layout for name, f in (("least", F.min), ("most", F.max))]
        empty = [F.bool_or(F.col(c).isNull()).alias(f"null_{c}") for c in layout]
        bounds = touched.agg(*ends, *empty).first()
        inside = []
        for c in layout:
            known = F.col(c).between(F.lit(bounds[f"least_{c}"]), F.lit(bounds[f"most_{c}"]))
            inside.append(known | F.col(c).isNull() if bounds[f"null_{c}"] else known)
        named = touched.select(*[F.col(c).alias(f"__{c}") for c in layout])
        equal = all_of([F.col(c).eqNullSafe(F.col(f"__{c}")) for c in layout])
        part = target.filter(all_of(inside)).join(named, equal, "left_semi")
        result = clustered(merged(part, df, keys).select(*target.columns), layout)
        with _dynamic_partitions(self.spark):
            result.write.insertInto(self.name(table), overwrite=True)
