"""Candles in batch and streaming, and change-event decoding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.operators import candles as cd
from candlewick.plans import inputs
from candlewick.plans.catalogue.registry import query, rounded, rounded_sql, scratch_lake
from candlewick.session import shared_dir
from candlewick.sources.landing import quotes
from candlewick.streaming import decode, live
from candlewick.streaming.store import CandleStore, StateStore

_CANDLE_SQL = """symbol, date_trunc('{unit}', timestamp) AS time_bucket, arg_min(price, row(timestamp, seq)) AS open,
  max(price) AS high, min(price) AS low, arg_max(price, row(timestamp, seq)) AS close, sum(volume) AS volume"""


def _candle_sql(unit: str, source: str = "ticks", tables: str = inputs.TICKS) -> str:
    return f"WITH {tables} SELECT {_CANDLE_SQL.format(unit=unit)} FROM {source} GROUP BY ALL"


@query("bars", f"WITH {inputs.BARS} SELECT * FROM bars")
def bars(spark, d):
    return inputs.bars(spark, d)


@query("bars_by_supplier", f"WITH {inputs.SUPPLIER_BARS} SELECT * FROM bars")
def bars_by_supplier(spark, d):
    return inputs.supplier_bars(spark, d)


@query("candles_by_minute", _candle_sql("minute"))
def candles_by_minute(spark, d):
    return cd.candles(inputs.ticks(spark, d))


@query("candles_by_day", _candle_sql("day"))
def candles_by_day(spark, d):
    return cd.candles(inputs.ticks(spark, d), "day")


@query(
    "candles_by_interval",
    f"""WITH {inputs.TICKS} SELECT symbol, time_bucket(INTERVAL '15 minutes', timestamp) AS time_bucket,
  arg_min(price, row(timestamp, seq)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, row(timestamp, seq)) AS close, sum(volume) AS volume FROM ticks GROUP BY ALL""",
)
def candles_by_interval(spark, d):
    return cd.candles(inputs.ticks(spark, d), "15 minutes")


@query("candles_from_partials", _candle_sql("hour"))
def candles_from_partials(spark, d):
    """Five overlapping batches of ticks become partial states; reading merges them."""
    ticks = inputs.ticks(spark, d)
    batches = [ticks.filter(F.pmod(F.hash("seq"), F.lit(5)) == i) for i in range(5)]
    states = reduce(DataFrame.unionByName, [cd.partials(b, "hour") for b in batches])
    return cd.read_candles(states)


_QUOTES = f"""{inputs.TICKS}, quotes AS (
  SELECT symbol, price AS current_price, price + volume AS high, price - volume AS low, timestamp, seq FROM ticks
  WHERE price <> 0)"""


def _quote_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Quotes as landed JSON; the day range around a price comes from the volume."""
    t = inputs.ticks(spark, d)
    price, spread = F.col("price"), F.col("volume")
    fields = {
        "c": price,
        "h": price + spread,
        "l": price - spread,
        "o": price,
        "pc": price - 1,
        "d": F.lit(1.0),
        "dp": spread / 100,
        "t": F.unix_seconds("timestamp"),
    }
    return t.select("symbol", "seq", F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("payload"))


@query(
    "quotes_from_json",
    f"""WITH {inputs.TICKS} SELECT symbol, price AS current_price, {rounded_sql("price + volume", 4, "high")},
  {rounded_sql("price - volume", 4, "low")}, price AS open, {rounded_sql("price - 1", 4, "previous_close")},
  1.0::DOUBLE AS change, volume / 100 AS percent_change, date_trunc('second', timestamp) AS timestamp
FROM ticks WHERE price <> 0""",
)
def quotes_from_json(spark, d):
    out = quotes(_quote_payloads(spark, d))
    shown = ["high", "low", "previous_close"]
    return out.select(*[rounded(c, 4) if c in shown else F.col(c) for c in out.columns])


@query(
    "quote_candles",
    f"""WITH {_QUOTES} SELECT symbol, date_trunc('hour', timestamp) AS time_bucket,
  arg_min(current_price, row(timestamp, seq)) AS open, max(high) AS high, min(low) AS low,
  arg_max(current_price, row(timestamp, seq)) AS close, count(*) AS volume FROM quotes GROUP BY ALL""",
)
def quote_candles(spark, d):
    ticks = inputs.ticks(spark, d).filter(F.col("price") != 0)
    price, spread = F.col("price"), F.col("volume")
    rows = ticks.select(
        "symbol", price.alias("current_price"), (price + spread).alias("high"), (price - spread).alias("low"), "timestamp", "seq"
    )
    return cd.quote_candles(rows, "hour", seq="seq")


@query(
    "candles_of_symbol_in_range",
    f"""WITH {inputs.TICKS} SELECT {_CANDLE_SQL.format(unit="minute")} FROM ticks
WHERE symbol = 'click' AND timestamp BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'
GROUP BY ALL ORDER BY time_bucket""",
)
def candles_of_symbol_in_range(spark, d):
    chosen = cd.between(inputs.ticks(spark, d), "2024-01-03 00:00:00", "2024-01-20 12:00:00", "click")
    return cd.candles(chosen).orderBy("time_bucket")


@query("symbols", f"WITH {inputs.TICKS} SELECT DISTINCT symbol FROM ticks ORDER BY symbol")
def symbols(spark, d):
    return cd.distinct_sorted(inputs.ticks(spark, d), "symbol")


@query(
    "daily_average_price",
    f"""WITH {inputs.TICKS} SELECT date_trunc('day', timestamp) AS time_bucket, {rounded_sql("avg(price)", 4, "average")}
FROM ticks GROUP BY 1 ORDER BY 1""",
)
def daily_average_price(spark, d):
    return cd.bucket_average(inputs.ticks(spark, d), "timestamp", "price").select("time_bucket", rounded("average", 4))


# --- change events -------------------------------------------------------------------------------------

_TICK_ROWS = f"""WITH {inputs.CHANGES} SELECT symbol, price, volume, date_trunc('second', timestamp) AS timestamp, seq
FROM changes WHERE op IN ('c', 'r')"""


@query("ticks_from_changes", _TICK_ROWS)
def ticks_from_changes(spark, d):
    good, _ = decode.split_broken(decode.json_envelopes(inputs.change_events(spark, d)))
    return decode.tick_rows(good, keep=["seq"])


@query("ticks_from_flat_changes", _TICK_ROWS)
def ticks_from_flat_changes(spark, d):
    e = decode.json_envelopes(inputs.change_events(spark, d))
    sides = [
        F.col(f"{side}.{f}").alias(f"{side}_{f}")
        for side in ("before", "after")
        for f in ("id", "symbol", "price", "volume", "timestamp")
    ]
    return decode.tick_rows(decode.flat_envelopes(e.select("seq", *sides, "op")), keep=["seq"])


_RECORD = "source.quotes.Value"


def _topic_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Changes in the nested topic form: every field sits under the record name and its type."""
    t = inputs.ticks(spark, d)
    kinds = {name: kind for name, kind in decode.TOPIC_FIELDS.items() if kind == "double"}
    cells = [F.struct(F.col("symbol").alias("string")).alias("symbol")]
    cells += [F.struct(F.col("price").alias(kind)).alias(name) for name, kind in kinds.items()]
    cells += [F.struct(F.unix_micros("timestamp").alias("long")).alias("timestamp")]
    op = F.element_at(F.array(*[F.lit(x) for x in "crud"]), (F.col("seq") % 4 + 1).cast("int"))
    after = F.when(op != "d", F.struct(F.struct(*cells).alias(_RECORD)))
    value = F.struct(F.struct(op.alias("op"), after.alias("after")).alias("value"))
    return t.select("seq", F.to_json(value).alias("payload"))


@query(
    "quotes_from_topic",
    f"""WITH {inputs.CHANGES} SELECT symbol, price AS current_price, price AS high, price AS low, price AS open,
  price AS previous_close, price AS change, price AS percent_change, timestamp, seq
FROM changes WHERE op = 'c' AND symbol <> ''""",
)
def quotes_from_topic(spark, d):
    good, _ = decode.split_broken(decode.topic_envelopes(_topic_payloads(spark, d), _RECORD))
    return decode.quote_rows(good, keep=["seq"])


@query(
    "current_state",
    f"""WITH {inputs.CHANGES}, newest AS (
  SELECT symbol, max(seq) AS seq FROM changes GROUP BY symbol)
SELECT CAST(c.seq AS INTEGER) AS id, c.symbol, c.price, CAST(c.volume AS BIGINT) AS volume,
       epoch_us(c.timestamp) // 1000 AS timestamp FROM changes c JOIN newest n ON c.symbol = n.symbol AND c.seq = n.seq
WHERE c.op <> 'd'""",
)
def current_state(spark, d):
    """Last image per symbol after all changes, deletes removed."""
    e, _ = decode.split_broken(decode.json_envelopes(inputs.change_events(spark, d)))
    empty = e.select("after.*").limit(0)
    return live.applied(empty, e, "symbol", ["seq"])


# --- streams: file source, all available data, results read back from the sink ----------------------------


def _landed_changes(spark: SparkSession, d: str, files: int | None = None) -> str:
    """Change events as text files, as a capture tool would leave them; dealt over ``files`` in no order, if given."""
    path = shared_dir(spark, "changes")
    events = inputs.change_events(spark, d)
    dealt = events if files is None else events.repartition(files, F.xxhash64("seq"))
    dealt.select("payload").write.text(path)
    return path


@query(
    "live_candles_stream",
    f"""WITH {inputs.CHANGES}, t AS (
  SELECT symbol, price, volume, date_trunc('second', timestamp) AS timestamp, seq FROM changes WHERE op IN ('c', 'r'))
SELECT {_CANDLE_SQL.format(unit="hour")} FROM t GROUP BY ALL""",
)
def live_candles_stream(spark, d):
    """Change stream to partial candles, several files per batch, then the merged view."""
    out, rejects, seen = (shared_dir(spark, name) for name in ("partials", "rejects", "checkpoint"))
    stream = decode.json_envelopes(decode.file_stream(spark, _landed_changes(spark, d), files_per_batch=2))
    store = live.partial_sink(out, "hour")
    live.start(stream, live.guarded_sink(lambda batch, i: store(_numbered_ticks(batch), i), rejects), seen).awaitTermination()
    return cd.read_candles(spark.read.parquet(out))


def _numbered_ticks(envelopes: DataFrame) -> DataFrame:
    return decode.tick_rows(envelopes, keep=[F.col("after.id").cast("long").alias("seq")])


def _candle_store(spark: SparkSession, d: str) -> CandleStore:
    """Hourly candles of the change stream: nine batches in no order, merged three at a time."""
    store, rejects = CandleStore(spark, shared_dir(spark, "candles"), "hour", fan=3), shared_dir(spark, "rejects")
    stream = decode.json_envelopes(decode.file_stream(spark, _landed_changes(spark, d, 9), files_per_batch=1))
    sink = store.candle_sink()
    each = live.guarded_sink(lambda batch, i: sink(_numbered_ticks(batch), i), rejects)
    live.start(stream, each, shared_dir(spark, "checkpoint")).awaitTermination()
    return store


_STORED = f"""WITH {inputs.CHANGES}, t AS (
  SELECT symbol, price, volume, date_trunc('second', timestamp) AS timestamp, seq FROM changes WHERE op IN ('c', 'r'))"""


@query("compacted_candles", f"{_STORED} SELECT {_CANDLE_SQL.format(unit='hour')} FROM t GROUP BY ALL")
def compacted_candles(spark, d):
    """Candle states of many batches after background merging."""
    return _candle_store(spark, d).candles()


@query(
    "stored_candles_in_range",
    f"""{_STORED}, c AS (SELECT {_CANDLE_SQL.format(unit='hour')} FROM t GROUP BY ALL)
SELECT * FROM c WHERE symbol = 'click' AND time_bucket BETWEEN TIMESTAMP '2024-01-03 04:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
)
def stored_candles_in_range(spark, d):
    """Stored candles of a symbol: the months of the range are the only folders read."""
    return _candle_store(spark, d).candles("2024-01-03 04:20:00", "2024-01-20 12:59:00", "click")


@query(
    "tick_table_stream",
    f"""WITH {inputs.CHANGES} SELECT symbol, price, volume, date_trunc('second', timestamp) AS timestamp,
  CAST(strftime(timestamp, '%Y%m') AS INTEGER) AS ym FROM changes WHERE op IN ('c', 'r')""",
)
def tick_table_stream(spark, d):
    """Change stream into the month-partitioned tick table, broken messages set aside."""
    out, rejects, seen = (shared_dir(spark, name) for name in ("ticks", "rejects", "checkpoint"))
    stream = decode.json_envelopes(decode.file_stream(spark, _landed_changes(spark, d)))

    def each(batch: DataFrame, batch_id: int) -> None:
        live.tick_sink(out)(decode.tick_rows(batch), batch_id)

    live.start(stream, live.guarded_sink(each, rejects), seen).awaitTermination()
    return spark.read.parquet(out).select("symbol", "price", "volume", "timestamp", "ym")


@query(
    "windowed_candles_stream",
    _candle_sql("hour"),
)
def windowed_candles_stream(spark, d):
    """Watermarked candles in update mode; the newest update per bucket is kept."""
    out, seen = shared_dir(spark, "windows"), shared_dir(spark, "checkpoint")
    source = spark.read.parquet(f"{d}/events.parquet").schema
    events = spark.readStream.schema(source).option("pathGlobFilter", "events.parquet").parquet(d)
    ticks = events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(out)

    candles = live.windowed_candles(ticks, "1 hour", "1 hour")
    writer = candles.writeStream.outputMode("update").foreachBatch(each)
    writer.option("checkpointLocation", seen).trigger(availableNow=True).start().awaitTermination()
    rest = ["open", "high", "low", "close", "volume"]
    newest = spark.read.parquet(out).groupBy("symbol", "time_bucket").agg(F.max_by(F.struct(*rest), "batch").alias("c"))
    return newest.select("symbol", "time_bucket", "c.*")


@query(
    "state_stream",
    f"""WITH {inputs.CHANGES}, newest AS (SELECT symbol, max(seq) AS seq FROM changes GROUP BY symbol)
SELECT CAST(c.seq AS INTEGER) AS id, c.symbol, c.price FROM changes c JOIN newest n ON c.symbol = n.symbol AND c.seq = n.seq
WHERE c.op <> 'd'""",
)
def state_stream(spark, d):
    """Current state kept by a stream of changes that come in no order, in five batches."""
    store, rejects = StateStore(spark, shared_dir(spark, "state"), "symbol", ["at"], fan=2), shared_dir(spark, "rejects")
    stream = decode.json_envelopes(decode.file_stream(spark, _landed_changes(spark, d, 5), files_per_batch=1))
    sink = store.change_sink()
    ordered = lambda batch: batch.withColumn("at", F.coalesce("after.id", "before.id"))
    each = live.guarded_sink(lambda batch, i: sink(ordered(batch), i), rejects)
    live.start(stream, each, shared_dir(spark, "checkpoint")).awaitTermination()
    return store.current().select("id", "symbol", "price")


@query(
    "quote_table_stream",
    f"""WITH {inputs.CHANGES} SELECT symbol, price AS current_price, price AS high, price AS previous_close, timestamp,
  CAST(strftime(timestamp, '%Y%m') AS INTEGER) AS ym FROM changes WHERE op = 'c' AND symbol <> ''""",
)
def quote_table_stream(spark, d):
    """Nested quote changes as a stream into the month-partitioned quote table."""
    landed, out, rejects, seen = (shared_dir(spark, name) for name in ("topic", "quotes", "rejects", "checkpoint"))
    _topic_payloads(spark, d).select("payload").write.text(landed)
    stream = decode.topic_envelopes(decode.file_stream(spark, landed), _RECORD)
    table = live.tick_sink(out)
    live.start(stream, live.guarded_sink(lambda batch, i: table(decode.quote_rows(batch), i), rejects), seen).awaitTermination()
    return spark.read.parquet(out).select("symbol", "current_price", "high", "previous_close", "timestamp", "ym")


@query(
    "quote_candles_stream",
    f"""WITH {inputs.TICKS}, q AS (SELECT symbol, price, volume, date_trunc('second', timestamp) AS timestamp, seq FROM ticks WHERE price <> 0),
b AS (SELECT symbol, date_trunc('hour', timestamp) AS time_bucket, arg_min(price, row(timestamp, seq)) AS open, max(price + volume) AS high,
  min(price - volume) AS low, arg_max(price, row(timestamp, seq)) AS close, count(*) AS volume FROM q GROUP BY ALL)
SELECT symbol, time_bucket, {", ".join(rounded_sql(c, 4) for c in ("open", "high", "low", "close"))}, volume FROM b""",
)
def quote_candles_stream(spark, d):
    """Landed JSON quotes, polled as a stream, to stored candle states and back."""
    landed, out, seen = (shared_dir(spark, name) for name in ("quotes", "partials", "checkpoint"))
    _quote_payloads(spark, d).select("symbol", "seq", "payload").write.json(landed)
    lines = spark.readStream.schema("symbol string, seq long, payload string").json(landed)
    sink = live.partial_sink(out, "hour", seq="seq", quotes=True)
    live.start(quotes(lines, keep=["seq"]), sink, seen).awaitTermination()
    candles = cd.read_candles(spark.read.parquet(out))
    return candles.select("symbol", "time_bucket", *[rounded(c, 4) for c in ("open", "high", "low", "close")], "volume")
