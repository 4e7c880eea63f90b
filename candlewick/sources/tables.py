"""Reads: CSV, parquet folders, JDBC, local rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from candlewick.sinks.layers import Lake


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header. Without a schema the types are inferred, at the price of a second pass over the files.

    A ``date`` column becomes a timestamp; text that is no date becomes NULL.
    """
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    if "date" in df.columns:
        df = df.withColumn("date", F.col("date").try_cast("timestamp"))
    return df


def read_ticker(spark: SparkSession, path: str, ticker: str, columns: Sequence[str] = ()) -> DataFrame:
    """Rows of one ticker from all files of a folder; the filter reaches the scan."""
    df = spark.read.parquet(path).filter(F.col("ticker") == ticker)
    return df.select(*columns) if columns else df


def local_rows(spark: SparkSession, rows: Sequence[Sequence[object]], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


@dataclass(frozen=True)
class Connection:
    """A stored database connection."""

    host: str
    port: int
    database: str
    user: str
    password: str = field(repr=False)
    properties: Mapping[str, str] = field(default_factory=dict)
    scheme: str = "postgresql"
    driver: str = "org.postgresql.Driver"

    @property
    def url(self) -> str:
        return f"jdbc:{self.scheme}://{self.host}:{self.port}/{self.database}"

    def jdbc_properties(self) -> dict[str, str]:
        """User, password and driver, overridden by the stored extra properties."""
        return {"user": self.user, "password": self.password, "driver": self.driver, **self.properties}


@dataclass(frozen=True)
class ReadSplit:
    """How a JDBC read is cut into parallel queries."""

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def jdbc_options(connection: Connection, table: str, split: ReadSplit | None = None, fetch_rows: int = 10000) -> dict[str, str]:
    base = {**connection.jdbc_properties(), "url": connection.url, "dbtable": table, "fetchsize": str(fetch_rows)}
    return {**base, **(split.options() if split else {})}


def read_jdbc(spark: SparkSession, connection: Connection, table: str, split: ReadSplit | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(connection, table, split)).load()


def read_layer(lake: Lake, table: str) -> DataFrame:
    return lake.read(table)
