"""Fixed schemas, looked up by name."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

OHLC = ["open", "high", "low", "close"]
OHLCV = [*OHLC, "volume"]
PRICE_KEY = ["symbol", "trade_date"]
PRICE_COLUMNS = [*PRICE_KEY, *OHLCV]


def _ohlcv() -> list[StructField]:
    return [StructField(c, DoubleType()) for c in OHLC] + [StructField("volume", LongType())]


def _star_fact() -> StructType:
    return StructType(
        [StructField("symbol_id", IntegerType(), False), StructField("date_id", IntegerType(), False)]
        + _ohlcv()
    )


_SCHEMAS = {
    "stock_prices": StructType(
        [StructField("symbol", StringType(), False), StructField("trade_date", DateType(), False)]
        + _ohlcv()
    ),
    "last_update": StructType(
        [StructField("symbol", StringType(), False), StructField("last_update", DateType(), False)]
    ),
    "metadata": StructType(
        [
            StructField("symbol", StringType(), False),
            StructField("last_update", DateType()),
            StructField("sector", StringType()),
        ]
    ),
    "directory": StructType(
        [
            StructField("symbol", StringType()),
            StructField("security_name", StringType()),
            StructField("market_category", StringType()),
            StructField("etf", StringType()),
            StructField("test_issue", StringType()),
            StructField("round_lot_size", IntegerType()),
        ]
    ),
    "trading_days": StructType(
        [StructField("date_id", IntegerType(), False), StructField("trade_date", DateType(), False)]
    ),
    "symbols": StructType(
        [
            StructField("symbol_id", IntegerType(), False),
            StructField("symbol", StringType(), False),
            StructField("is_etf", BooleanType()),
        ]
    ),
    "stock_prices_star": _star_fact(),
    "etf_prices_star": _star_fact(),
    "symbol_listing": StructType(
        [
            StructField("symbol", StringType(), False),
            StructField("security_name", StringType()),
            StructField("market_category", StringType()),
            StructField("is_etf", BooleanType()),
            StructField("round_lot_size", IntegerType()),
        ]
    ),
    "load_intents": StructType(
        [
            StructField("intent_id", StringType(), False),
            StructField("state", StringType(), False),
            StructField("operation", StringType()),
            StructField("table_name", StringType()),
            StructField("path", StringType()),
            StructField("committed_at", TimestampType()),
        ]
    ),
    "load_ledger": StructType(
        [
            StructField("snapshot_id", LongType(), False),
            StructField("committed_at", TimestampType(), False),
            StructField("operation", StringType(), False),
            StructField("table_name", StringType(), False),
            StructField("added_rows", LongType(), False),
        ]
    ),
}


def schema_for(name: str) -> StructType:
    """The declared schema called ``name``; an unknown name is an error."""
    if name not in _SCHEMAS:
        raise ValueError(f"no schema named {name!r}; known: {sorted(_SCHEMAS)}")
    return _SCHEMAS[name]
