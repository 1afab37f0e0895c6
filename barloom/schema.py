"""Table shapes."""

from __future__ import annotations

from pyspark.sql import types as T

# The forecast attributes, and the column names of stored bars and of API payloads.
ATTRIBUTES = ["close", "high", "low", "open", "volume"]

STORED_NAMES = {
    "ticker_name": "ticker",
    "trading_date": "trading_date",
    "open_price": "open",
    "high_price": "high",
    "low_price": "low",
    "close_price": "close",
    "volume": "volume",
}

API_NAMES = {
    "ticker": "ticker",
    "tradingDate": "trading_date",
    "open": "open",
    "high": "high",
    "low": "low",
    "close": "close",
    "volume": "volume",
}

_PRICE = T.DoubleType()

BAR = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("trading_date", T.DateType()),
        T.StructField("open", _PRICE),
        T.StructField("high", _PRICE),
        T.StructField("low", _PRICE),
        T.StructField("close", _PRICE),
        T.StructField("volume", T.LongType()),
    ]
)

BAR_COLUMNS = BAR.names
PRICES = [f.name for f in BAR.fields if f.dataType == _PRICE]


def _edge_type(name: str) -> T.DataType:
    if name in ("ticker", "trading_date"):
        return T.StringType()
    return T.LongType() if name == "volume" else _PRICE


# Stored JSON: the date is an ISO instant, columns come in alphabetical order.
STORED = T.StructType([T.StructField(k, _edge_type(v)) for k, v in sorted(STORED_NAMES.items())])

# JSON written straight from the API keeps the API's names.
API_ROW = T.StructType([T.StructField(k, _edge_type(v)) for k, v in API_NAMES.items()])

# A landed response: its text and the HTTP status.
LANDED = T.StructType([T.StructField("status", T.IntegerType()), T.StructField("payload", T.StringType())])
