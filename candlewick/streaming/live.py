"""Streaming queries: tick table, live candles, current state.

Sinks run in ``foreachBatch`` and write one partition per batch id with dynamic overwrite, so a batch that is
replayed after a failure replaces its own output and counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions.timefn import month_key
from candlewick.operators.candles import CANDLE, moment, partials, quote_partials, read_candles
from candlewick.sinks.layers import Lake, clustered, merged, without
from candlewick.streaming.decode import split_broken

Batch = Callable[[DataFrame, int], None]


def start(stream: DataFrame, each: Batch, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``each`` per micro-batch: on a fixed interval, or over everything that is there now and then stop."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _write_batch(df: DataFrame, path: str, batch_id: int, month_of: str, sort: Sequence[str]) -> None:
    out = df.withColumn("ym", month_key(F.col(month_of))).withColumn("batch", F.lit(batch_id))
    (
        clustered(out, ["ym"]).sortWithinPartitions("ym", *sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ym", "batch")
        .parquet(path)
    )


def tick_sink(path: str) -> Batch:
    """Append ticks to a table partitioned by month and sorted by symbol and time, with the time of arrival."""

    def each(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("ingested_at", F.current_timestamp())
        _write_batch(stamped, path, batch_id, "timestamp", ["symbol", "timestamp"])

    return each


def partial_sink(path: str, width: str = "minute", seq: str | None = "seq", quotes: bool = False) -> Batch:
    """Store each batch's candle states. Late ticks add one more state; reading merges them, however late."""
    build = quote_partials if quotes else partials

    def each(batch: DataFrame, batch_id: int) -> None:
        _write_batch(build(batch, width, seq), path, batch_id, "time_bucket", ["symbol", "time_bucket"])

    return each


class TooManyBroken(RuntimeError):
    """A batch held more broken messages than allowed."""


def guarded_sink(good_sink: Batch, reject_path: str, most_broken: int | None = None) -> Batch:
    """Send readable messages on and broken ones to ``reject_path``, all of them.

    ``most_broken`` stops the query at a batch with more, for feeds whose owner asks for it.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        good, broken = split_broken(batch.persist())
        try:
            (
                broken.withColumn("batch", F.lit(batch_id))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch")
                .parquet(reject_path)
            )
            if most_broken is not None and broken.limit(most_broken + 1).count() > most_broken:
                raise TooManyBroken(f"more than {most_broken} broken messages in batch {batch_id}")
            good_sink(good, batch_id)
        finally:
            batch.unpersist()

    return each


def stored_candles(df: DataFrame) -> DataFrame:
    """Candles from a partial-state table."""
    return read_candles(df)


def windowed_candles(stream: DataFrame, width: str = "1 minute", delay: str = "10 minutes", seq: str | None = "seq") -> DataFrame:
    """Candles with bounded state: ticks later than ``delay`` are not counted.

    Use update mode for live candles; append mode holds a candle back until the watermark has passed it.
    """
    at = moment(seq=seq)
    return (
        stream.withWatermark("timestamp", delay)
        .groupBy("symbol", F.window("timestamp", width).alias("_window"))
        .agg(
            F.min_by("price", at).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", at).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .withColumn("time_bucket", F.col("_window.start"))
        .select(*CANDLE)
    )


# --- current state ------------------------------------------------------------------------------------


def newest_changes(envelopes: DataFrame, key: str, at: Sequence[str]) -> DataFrame:
    """The last change per key; deletes carry their key in the before image."""
    keyed = envelopes.withColumn("_key", F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")))
    last = F.max_by(F.struct("op", "after"), F.struct(*at))
    return keyed.groupBy("_key").agg(last.alias("_last")).select("_key", "_last.op", "_last.after")


def applied(state: DataFrame, envelopes: DataFrame, key: str, at: Sequence[str]) -> DataFrame:
    """State after a set of changes: creates, snapshots and updates replace a row, deletes remove it."""
    last = newest_changes(envelopes, key, at)
    gone = last.filter(F.col("op") == "d").select(F.col("_key").alias(key))
    alive = last.filter((F.col("op") != "d") & F.col("after").isNotNull()).select("after.*")
    return merged(without(state, gone, [key]), alive, [key])


def state_sink(lake: Lake, table: str, key: str, at: Sequence[str]) -> Batch:
    """Keep a current-state table: one upsert per batch, one delete if it holds deletes. Replays change nothing.

    Batches have to come in the order of their changes; ``StateStore`` takes them in any order."""

    def each(batch: DataFrame, batch_id: int) -> None:
        last = newest_changes(batch, key, at).persist()
        try:
            alive = last.filter((F.col("op") != "d") & F.col("after").isNotNull()).select("after.*")
            lake.upsert(alive, table, [key])
            gone = last.filter(F.col("op") == "d").select(F.col("_key").alias(key))
            if not gone.isEmpty():
                lake.delete(gone, table, [key])
        finally:
            last.unpersist()

    return each
