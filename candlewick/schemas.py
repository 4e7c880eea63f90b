"""Column contracts of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Feature columns a model is trained on, in order.
PRICE_FEATURES = [
    "MA_20",
    "MA_200",
    "EMA_26",
    "MACD",
    "MACD_signal",
    "RSI",
    "Stoch_K",
    "ROC",
    "BB_width",
    "ATR",
    "OBV",
    "VWAP",
    "Return",
    "Price_Change_Pct",
    "High_Low_Range",
    "Open_Close_Range",
]
SENTIMENT_FEATURES = ["sentiment_sum", "polarity_ratio"]
FEATURES = PRICE_FEATURES + SENTIMENT_FEATURES
TARGET = "next_day_return"

# Label scores.
LABEL_SCORES = {"positive": 1.0, "negative": -1.0, "neutral": 0.0}

# Rules and names used when the caller gives none.
DEFAULT_RULES = {
    "NVDA": {"aliases": ["nvidia", "jensen huang", "geforce", "rtx", "nvda"], "blacklist": []},
    "MSFT": {"aliases": ["microsoft", "satya nadella", "azure", "msft"], "blacklist": []},
}
COMPANY_NAMES = {"NVDA": "Nvidia", "MSFT": "Microsoft"}

STAMP = "ingestion_timestamp"

BARS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("ticker", T.StringType()),
    ]
)

NEWS_RAW = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("themes", T.StringType()),
        T.StructField("organizations", T.StringType()),
        T.StructField("tone", T.StringType()),
        T.StructField("extras", T.StringType()),
    ]
)

QUOTE_PAYLOAD = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in ("c", "h", "l", "o", "pc", "d", "dp", "t")]
)

# Quote payload key -> stored column.
QUOTE_COLUMNS = {
    "c": "current_price",
    "h": "high",
    "l": "low",
    "o": "open",
    "pc": "previous_close",
    "d": "change",
    "dp": "percent_change",
}

TICK_IMAGE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

QUOTE_IMAGE = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("symbol", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in QUOTE_COLUMNS.values()]
    + [T.StructField("timestamp", T.LongType())]
)


def envelope(image: T.StructType) -> T.StructType:
    """Change-event envelope around a row image; before and after may be null."""
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
        ]
    )
