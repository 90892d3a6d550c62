"""Declared schemas of the tick data model and the quote message enums.

Nothing here is inferred: every reader and parser takes one of these
``StructType``s so Catalyst can prune columns (``from_json`` only keeps the
fields that are used downstream).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Record layout of a topic (the Kafka source schema). File-backed topics use the
# same columns so one code path serves both.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# JSON payload of one tick: 3 of the 33 quote fields. ``time`` is a string of
# epoch milliseconds because the JSON form of a 64-bit integer is a string.
TICK_JSON_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("price", T.FloatType()),
        T.StructField("time", T.StringType()),
    ]
)

# Parsed tick row.
TICK_SCHEMA = T.StructType(
    [
        T.StructField("stock_ticker", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("price", T.FloatType()),
    ]
)

# Windowed output / keyed target table: key (stock_ticker, timestamp), all NOT NULL.
OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("stock_ticker", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("price", T.DoubleType(), False),
    ]
)
OUTPUT_KEYS = ("stock_ticker", "timestamp")

# ---------------------------------------------------------------------------
# The quote message definition (field name, field number, wire
# type) and its enums. These must equal the published message definition for
# frames to decode, so they are stated here as data, in field-number order.
# ---------------------------------------------------------------------------
QUOTE_FIELDS = [
    ("id", 1, "string"),
    ("price", 2, "float"),
    ("time", 3, "sint64"),
    ("currency", 4, "string"),
    ("exchange", 5, "string"),
    ("quoteType", 6, "enum:QuoteType"),
    ("marketHours", 7, "enum:MarketHoursType"),
    ("changePercent", 8, "float"),
    ("dayVolume", 9, "sint64"),
    ("dayHigh", 10, "float"),
    ("dayLow", 11, "float"),
    ("change", 12, "float"),
    ("shortName", 13, "string"),
    ("expireDate", 14, "sint64"),
    ("openPrice", 15, "float"),
    ("previousClose", 16, "float"),
    ("strikePrice", 17, "float"),
    ("underlyingSymbol", 18, "string"),
    ("openInterest", 19, "sint64"),
    ("optionsType", 20, "enum:OptionType"),
    ("miniOption", 21, "sint64"),
    ("lastSize", 22, "sint64"),
    ("bid", 23, "float"),
    ("bidSize", 24, "sint64"),
    ("ask", 25, "float"),
    ("askSize", 26, "sint64"),
    ("priceHint", 27, "sint64"),
    ("vol_24hr", 28, "sint64"),
    ("volAllCurrencies", 29, "sint64"),
    ("fromcurrency", 30, "string"),
    ("lastMarket", 31, "string"),
    ("circulatingSupply", 32, "double"),
    ("marketcap", 33, "double"),
]

QUOTE_TYPE = {
    0: "NONE",
    5: "ALTSYMBOL",
    7: "HEARTBEAT",
    8: "EQUITY",
    9: "INDEX",
    11: "MUTUALFUND",
    12: "MONEYMARKET",
    13: "OPTION",
    14: "CURRENCY",
    15: "WARRANT",
    17: "BOND",
    18: "FUTURE",
    20: "ETF",
    23: "COMMODITY",
    28: "ECNQUOTE",
    41: "CRYPTOCURRENCY",
    42: "INDICATOR",
    1000: "INDUSTRY",
}
OPTION_TYPE = {0: "CALL", 1: "PUT"}
MARKET_HOURS_TYPE = {
    0: "PRE_MARKET",
    1: "REGULAR_MARKET",
    2: "POST_MARKET",
    3: "EXTENDED_HOURS_MARKET",
}
ENUMS = {
    "QuoteType": QUOTE_TYPE,
    "OptionType": OPTION_TYPE,
    "MarketHoursType": MARKET_HOURS_TYPE,
}

_SPARK_TYPE = {
    "string": T.StringType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "sint64": T.LongType(),
}


def quote_struct() -> T.StructType:
    """All 33 quote fields as a Spark struct; enums are carried as names."""
    fields = []
    for name, _num, kind in QUOTE_FIELDS:
        dtype = T.StringType() if kind.startswith("enum:") else _SPARK_TYPE[kind]
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


QUOTE_SCHEMA = quote_struct()
