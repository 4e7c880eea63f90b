"""File and JDBC outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def write_predictions(df: DataFrame, path: str, stamp: str | None = None) -> None:
    """Predictions as JSON lines, one folder per stock and run: ``stock=<s>/run=<stamp>``."""
    run = F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss") if stamp is None else F.lit(stamp)
    df.withColumn("run", run).write.mode("append").partitionBy("stock", "run").json(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with header. ``single_file`` sends all rows through one task, so keep it for small results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def export_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, batch_rows: int = 1000, writers: int = 8
) -> None:
    """Append in multi-row inserts; at most ``writers`` tasks hold a connection at once."""
    options = {**dict(properties or {}), "batchsize": str(batch_rows), "numPartitions": str(writers)}
    df.write.jdbc(url, table, mode="append", properties=options)
