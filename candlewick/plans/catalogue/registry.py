"""Named queries over the given tables, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from candlewick.session import shared_dir
from candlewick.sinks.layers import Lake

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} exists already")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain_times(build(spark, sf_dir))

        REGISTRY[name] = Query(name, run, sql)
        return build

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that results do not depend on the reader's clock."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def scratch_lake(spark: SparkSession) -> Lake:
    """Layers of their own for one query, in the shared folder."""
    root = shared_dir(spark, "lake")
    return Lake(spark, root, prefix=f"{root[-12:]}_".replace("-", "_").rjust(14, "x"))


def rounded(column: str | Column, digits: int = 6, name: str | None = None) -> Column:
    """Rounded for display. A nudge far below the last digit settles ties (averages of cents often end in a 5), so
    that the order of a sum cannot tip them; adding zero removes a negative zero."""
    value = F.col(column) if isinstance(column, str) else column
    out = F.round(value + F.lit(10.0 ** -(digits + 3)), digits) + F.lit(0.0)
    return out.alias(name or column)


def rounded_sql(expression: str, digits: int = 6, name: str | None = None) -> str:
    """The same in SQL."""
    return f"round({expression} + 1e-{digits + 3}::DOUBLE, {digits}) + 0.0 AS {name or expression}"
