"""Change events to rows. Every function works on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from candlewick.functions.timefn import from_epoch_ms, from_epoch_us
from candlewick.schemas import QUOTE_COLUMNS, TICK_IMAGE, envelope

CORRUPT = "_corrupt"

# Field types of the nested topic form, as the encoder names them.
TOPIC_FIELDS = {"symbol": "string", **{name: "double" for name in QUOTE_COLUMNS.values()}, "timestamp": "long"}
_SPARK_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType()}


# --- sources ---------------------------------------------------------------------------------------


def kafka_stream(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Topic as ``payload`` text and raw ``value`` bytes. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    df = reader.options(**dict(options or {})).load()
    return df.select("value", F.col("value").cast("string").alias("payload"), "topic", "partition", "offset")


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files of a folder as ``payload``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("value").alias("payload"))


# --- envelopes -------------------------------------------------------------------------------------


def json_envelopes(df: DataFrame, image: T.StructType = TICK_IMAGE, payload: str = "payload") -> DataFrame:
    """``before, after, op`` from JSON text; unreadable text goes to ``_corrupt``."""
    schema = T.StructType([*envelope(image).fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rest = [c for c in df.columns if c != payload]
    return df.select(*rest, F.from_json(payload, schema, options).alias("_e")).select(*rest, "_e.*")


def topic_envelopes(
    df: DataFrame, record: str, fields: Mapping[str, str] | None = None, payload: str = "payload"
) -> DataFrame:
    """The same columns from the nested form ``value.after.<record>.<field>.<type>``.

    Fields that are absent stay NULL.
    """
    fields = dict(fields or TOPIC_FIELDS)
    cells = T.StructType(
        [T.StructField(n, T.StructType([T.StructField(kind, _SPARK_TYPES[kind])])) for n, kind in fields.items()]
    )
    side = T.StructType([T.StructField(record, cells)])
    value = T.StructType([T.StructField("op", T.StringType()), T.StructField("after", side)])
    schema = T.StructType([T.StructField("value", value), T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rest = [c for c in df.columns if c != payload]
    parsed = df.select(*rest, F.from_json(payload, schema, options).alias("_e"))
    row = F.col("_e.value.after").getField(record)
    after = F.struct(*[row.getField(n).getField(kind).alias(n) for n, kind in fields.items()])
    return parsed.select(
        *rest, F.when(row.isNotNull(), after).alias("after"), F.col("_e.value.op").alias("op"), F.col(f"_e.{CORRUPT}")
    )


def flat_envelopes(df: DataFrame, image: T.StructType = TICK_IMAGE) -> DataFrame:
    """``before, after, op`` from flattened nullable columns ``before_<f>``, ``after_<f>``; no id means no image."""

    def side(name: str):
        fields = [F.col(f"{name}_{f.name}").cast(f.dataType).alias(f.name) for f in image.fields]
        return F.when(F.col(f"{name}_id").isNotNull(), F.struct(*fields)).alias(name)

    flat = {f"{s}_{f.name}" for s in ("before", "after") for f in image.fields}
    rest = [c for c in df.columns if c not in flat and c != "op"]
    return df.select(*rest, side("before"), side("after"), "op")


def avro_envelopes(df: DataFrame, reader_schema: str, value: str = "value") -> DataFrame:
    """The same columns from registry-framed Avro: one magic byte and a four-byte schema id precede the data.

    Needs the Avro connector on the class path.
    """
    from pyspark.sql.avro.functions import from_avro

    body = F.expr(f"substring({value}, 6, length({value}) - 5)")
    rest = [c for c in df.columns if c != value]
    return df.select(*rest, from_avro(body, reader_schema, {"mode": "PERMISSIVE"}).alias("_e")).select(*rest, "_e.*")


def split_broken(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable and broken messages."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


# --- rows ------------------------------------------------------------------------------------------


def tick_rows(envelopes: DataFrame, ops: Sequence[str] = ("c", "r"), keep: Sequence[str] = ()) -> DataFrame:
    """Ticks from creates and snapshots; times are milliseconds, cut to seconds."""
    kept = envelopes.filter(F.col("op").isin(*ops) & F.col("after").isNotNull())
    return kept.select(
        F.col("after.symbol").alias("symbol"),
        F.col("after.price").alias("price"),
        F.col("after.volume").cast("double").alias("volume"),
        from_epoch_ms(F.col("after.timestamp")).alias("timestamp"),
        *keep,
    )


def quote_rows(envelopes: DataFrame, ops: Sequence[str] = ("c",), keep: Sequence[str] = ()) -> DataFrame:
    """Quotes with a symbol from creates; times are microseconds."""
    named = F.col("after.symbol").isNotNull() & (F.col("after.symbol") != "")
    kept = envelopes.filter(F.col("op").isin(*ops) & named)
    return kept.select(
        F.col("after.symbol").alias("symbol"),
        *[F.col(f"after.{name}").alias(name) for name in QUOTE_COLUMNS.values()],
        from_epoch_us(F.col("after.timestamp")).alias("timestamp"),
        *keep,
    )
