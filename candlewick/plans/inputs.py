"""The given tables in the roles of bars, ticks, news, scores and versions, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.operators.indicators import forward_label, price_changes, returns, sma

START = "2024-01-01"

# Rules over frequent words of the sample texts.
SAMPLE_RULES = {
    "THER": {"aliases": ["thatin", "inoran", "the hers"], "blacklist": ["pills"]},
    "TION": {"aliases": ["orantion", "ononst"], "blacklist": ["eaux", "der die"]},
    "EAUX": {"aliases": ["eaux", "tion+"], "blacklist": []},
}
SAMPLE_POSITIVE = ["the", "la", "und", "re"]
SAMPLE_NEGATIVE = ["of", "de", "der", "and"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- bars -------------------------------------------------------------------------------------------


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of order prices per priority: at most one row per priority and calendar day."""
    price = F.col("o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            F.min_by(price, "o_orderkey").alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, "o_orderkey").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
    )


BARS = """bars AS (
  SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
         arg_max(o_totalprice, o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY ALL)"""


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of line prices per supplier."""
    price = F.col("l_extendedprice")
    # Order, line, then price in cents, as one number: a struct would make the aggregate sort its input.
    line = F.col("l_orderkey").cast("decimal(19,0)") * 10000 + F.col("l_linenumber")
    at = line.cast("decimal(25,0)") * 10**12 + F.round(price * 100).cast("decimal(12,0)")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.col("l_shipdate").cast("date").alias("date"),
        price.alias("price"),
        "l_quantity",
        at.alias("at"),
    )
    return lines.groupBy("ticker", "date").agg(
        F.min_by("price", "at").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "at").alias("close"),
        F.sum("l_quantity").alias("volume"),
    )


SUPPLIER_BARS = """bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS open,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS close,
         sum(l_quantity) AS volume
  FROM lineitem GROUP BY ALL)"""

# Feature rows used by the training queries.
FEATURE_COLUMNS = ["MA_20", "Return", "High_Low_Range", "volume"]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = forward_label(price_changes(returns(sma(bars(spark, sf_dir), [20]))))
    return labelled.select("ticker", "date", *FEATURE_COLUMNS, "next_day_return")


FEATURES = f"""{BARS}, moved AS (
  SELECT *, avg(close) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS MA_20,
         close / nullif(lag(close) OVER w, 0) - 1 AS Return, high - low AS High_Low_Range
  FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)),
features AS (
  SELECT ticker, date, MA_20, Return, High_Low_Range, volume,
         lead(Return) OVER (PARTITION BY ticker ORDER BY date) AS next_day_return FROM moved)"""

# --- ticks ------------------------------------------------------------------------------------------


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks: symbol, price, volume, timestamp, seq."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )


TICKS = """ticks AS (
  SELECT event_type AS symbol, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         ts AS timestamp, event_id AS seq FROM events)"""


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as change events: ``seq``, ``payload`` JSON. The kind of change cycles with the event number;
    deletes have no after image, creates and snapshots no before image."""
    op = F.element_at(F.array(*[F.lit(x) for x in "crud"]), (F.col("seq") % 4 + 1).cast("int"))
    image = F.struct(
        F.col("seq").cast("int").alias("id"),
        "symbol",
        "price",
        F.col("volume").cast("long").alias("volume"),
        F.unix_millis("timestamp").alias("timestamp"),
    )
    tagged = ticks(spark, sf_dir).select("seq", op.alias("op"), image.alias("image"))
    return tagged.select(
        "seq",
        F.to_json(
            F.struct(
                F.when(F.col("op").isin("u", "d"), F.col("image")).alias("before"),
                F.when(F.col("op") != "d", F.col("image")).alias("after"),
                "op",
            )
        ).alias("payload"),
    )


CHANGES = f"""{TICKS}, changes AS (
  SELECT *, CAST(list_extract(['c', 'r', 'u', 'd'], CAST(seq % 4 + 1 AS INTEGER)) AS VARCHAR) AS op FROM ticks)"""

# --- news ---------------------------------------------------------------------------------------------


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as headlines (whole texts), one every 37 minutes."""
    at = F.lit(START).cast("timestamp") + F.make_dt_interval(mins=F.col("doc_id").cast("int") * 37)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("text").alias("extracted_title"),
        F.concat(F.lit("https://news.example.com/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias(
            "source_url"
        ),
        "lang",
        at.alias("timestamp_utc"),
    )


NEWS = f"""news AS (
  SELECT doc_id, text AS extracted_title, 'https://news.example.com/' || source || '/' || doc_id AS source_url, lang,
         TIMESTAMP '{START} 00:00:00' + to_minutes(doc_id * 37) AS timestamp_utc FROM documents),
dated_news AS (
  SELECT *, CASE WHEN hour(timestamp_et) < 9 THEN CAST(timestamp_et AS DATE)
            ELSE CAST(timestamp_et AS DATE) + 1 END AS date
  FROM (SELECT *, timezone('America/New_York', timezone('UTC', timestamp_utc)) AS timestamp_et FROM news))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: good ones count as positive, toxic ones as negative, the rest as neutral."""
    from candlewick.functions.numeric import label_score
    from candlewick.functions.timefn import market_time, trading_date

    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    labels = table(spark, sf_dir, "labels").select("doc_id", label.alias("sentiment_label"))
    dated = news(spark, sf_dir).withColumn("date", trading_date(market_time(F.col("timestamp_utc"))))
    joined = dated.select("doc_id", "date", F.col("lang").alias("ticker")).join(labels, "doc_id")
    return joined.withColumn("sentiment_score", label_score(F.col("sentiment_label")))


SCORED = f"""{NEWS}, scored AS (
  SELECT n.doc_id, n.date, n.lang AS ticker,
         CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment_label,
         CASE WHEN toxic = 1 THEN -1.0::DOUBLE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sentiment_score
  FROM dated_news n JOIN labels l USING (doc_id))"""

# --- versions ----------------------------------------------------------------------------------------


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as versions of a job; the newest user turn is the active one."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("job_id"),
        F.col("turn").alias("version_id"),
        (F.col("role") == "user").alias("is_active"),
        F.col("text").alias("config"),
    )


VERSIONS = """versions AS (
  SELECT conv_id AS job_id, turn AS version_id, role = 'user' AS is_active, text AS config FROM conversations)"""
