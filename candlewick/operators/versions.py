"""Versioned rows: newest, active and next version per key, and the frames that change them.

All per-key picks are aggregates, which combine map-side, so a key with very many versions is no hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``by``. NULLs in ``by`` come first."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*by)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def latest(df: DataFrame, keys: Sequence[str], version: str = "version_id") -> DataFrame:
    """The row with the highest version per key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def active(df: DataFrame, keys: Sequence[str], version: str = "version_id") -> DataFrame:
    """The active row per key."""
    return latest(df.filter(F.col("is_active")), keys, version)


def next_version(df: DataFrame, keys: Sequence[str], version: str = "version_id") -> DataFrame:
    return df.groupBy(*keys).agg((F.coalesce(F.max(version), F.lit(0)) + 1).cast("long").alias("next_version"))


def versions_newest_first(df: DataFrame, keys: Sequence[str], version: str = "version_id") -> DataFrame:
    return df.orderBy(*keys, F.col(version).desc())


def with_new_versions(history: DataFrame, arriving: DataFrame, keys: Sequence[str], version: str = "version_id") -> DataFrame:
    """History plus one new active version per arriving key; older versions of these keys become inactive.

    ``arriving`` holds at most one row per key, without version and activity columns.
    """
    last = history.groupBy(*keys).agg(F.max(version).alias("_last"))
    fresh = arriving.join(last, list(keys), "left").select(
        *arriving.columns,
        (F.coalesce("_last", F.lit(0)) + 1).cast(history.schema[version].dataType).alias(version),
        F.lit(True).alias("is_active"),
    )
    touched = arriving.select(*keys).withColumn("_touched", F.lit(True))
    old = history.join(touched, list(keys), "left").select(
        *[c for c in history.columns if c != "is_active"],
        (F.col("is_active") & F.col("_touched").isNull()).alias("is_active"),
    )
    return old.unionByName(fresh, allowMissingColumns=True)


def activated(history: DataFrame, chosen: DataFrame, keys: Sequence[str], version: str = "version_id") -> DataFrame:
    """Make the chosen ``(keys, version)`` the active one of its key; other keys stay as they are."""
    picks = chosen.select(*keys, F.col(version).alias("_chosen"))
    joined = history.join(picks, list(keys), "left")
    flag = F.when(F.col("_chosen").isNull(), F.col("is_active")).otherwise(F.col(version) == F.col("_chosen"))
    return joined.select(*[c for c in history.columns if c != "is_active"], flag.alias("is_active"))


def soft_deleted(df: DataFrame, which: Column, now: Column | None = None) -> DataFrame:
    """Mark rows as deleted instead of removing them."""
    changed = {"status": F.when(which, F.lit("deleted")).otherwise(F.col("status"))}
    if "updated_at" in df.columns:
        stamp = F.current_timestamp() if now is None else now
        changed["updated_at"] = F.when(which, stamp).otherwise(F.col("updated_at"))
    return df.withColumns(changed)  # both look at the row as it was


def changed(stored: DataFrame, arriving: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Arriving rows with an ``action``: Created, Updated or Existed. NULLs compare as equal."""
    known = stored.select(*keys, F.struct(*compare).alias("_stored"))
    joined = arriving.join(known, list(keys), "left")
    action = (
        F.when(F.col("_stored").isNull(), "Created")
        .when(F.struct(*compare).eqNullSafe(F.col("_stored")), "Existed")
        .otherwise("Updated")
    )
    return joined.select(*arriving.columns, action.alias("action"))


def canonical_json(text: Column) -> Column:
    """JSON text in one spelling: keys in order, no spaces. Texts that mean the same have the same; NULL for text that isn't JSON."""
    return F.to_json(F.try_parse_json(text))


def config_json(df: DataFrame, columns: Sequence[str], name: str = "config") -> DataFrame:
    """The columns as one JSON config in canonical form, missing values included, with its hash."""
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.withColumn(name, canonical_json(text)).withColumn(f"{name}_hash", F.sha2(name, 256))


def with_updates(
    stored: DataFrame, arriving: DataFrame, keys: Sequence[str], config: str = "config", now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """The stored rows after configs arrive, and the arriving rows with their ``action``.

    A config that means something else than the one in use is an update: the row in use is marked deleted, and a new active row comes in. The same config,
    however it is written, changes nothing; a key without a row in use gets one. ``stored`` has ``status`` and ``updated_at``;
    ``arriving`` has keys and config, a row per key. Rows with a NULL key never find one in use, so they come in again.
    """
    stamp = F.current_timestamp() if now is None else now
    meaning = F.coalesce(canonical_json(F.col(config)), F.col(config))
    used = F.coalesce(F.col("status") != "deleted", F.lit(True))
    in_use = stored.filter(used).select(*keys, F.struct(meaning.alias("m")).alias("_used"))
    joined = arriving.join(in_use, list(keys), "left")
    same = F.col("_used.m").eqNullSafe(meaning)
    judged = joined.select(*arriving.columns, F.when(F.col("_used").isNull(), "Created").when(same, "Existed").otherwise("Updated").alias("action"))
    replaced = judged.filter(F.col("action") == "Updated").select(*keys, F.lit(True).alias("_replaced"))
    marked = stored.join(replaced, list(keys), "left").select(*stored.columns, "_replaced")
    old = soft_deleted(marked, F.col("_replaced").isNotNull() & used, stamp).select(*stored.columns)
    new = judged.filter(F.col("action") != "Existed").drop("action").select("*", F.lit("active").alias("status"), stamp.alias("updated_at"))
    return old.unionByName(new, allowMissingColumns=True), judged


def has_rows(df: DataFrame) -> bool:
    """Existence test that reads no more than it must."""
    return not df.isEmpty()


def existing(keys: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """The keys that occur in the table."""
    return keys.join(table.select(*on), list(on), "left_semi")


def run_summary(history: DataFrame, key: str = "job_id") -> DataFrame:
    """Runs, share of successes, and time and status of the last run per job."""
    return history.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.avg((F.col("status") == "success").cast("double")).alias("success_rate"),
        F.max("run_at").alias("last_run_at"),
        F.max_by("status", "run_at").alias("last_run_status"),
    )
