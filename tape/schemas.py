"""Table contracts: raw tick tables, the issue log and the value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source system's domains and lists.
# ---------------------------------------------------------------------------
TRADE_FLAGS = ["OK", "PRICE_OUTLIER", "SIZE_OUTLIER", "STALE", "MISSING_FIELD"]
QUOTE_FLAGS = ["OK", "CROSSED_SPREAD", "WIDE_SPREAD", "STALE", "MISSING_FIELD"]
BOOK_FLAGS = ["OK", "CROSSED_BOOK", "MISSING_LEVELS", "STALE"]
SEVERITIES = ["INFO", "WARNING", "CRITICAL"]
SIDES = ["bid", "ask"]
EXCHANGES = ["NYSE", "NASDAQ", "ARCA", "BATS", "IEX", "EDGX"]
TRADE_CONDITIONS = ["@", "F", "T", "I", "W"]
BOOK_LEVELS = 10
UNSIGNED_MAX = 4294967295   # sizes are unsigned 32-bit numbers
SESSION_OPEN = (14, 30)   # UTC hour, minute
SESSION_CLOSE = (21, 0)
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# ---------------------------------------------------------------------------

TRADES = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("trade_price", T.DoubleType(), False),
    T.StructField("trade_size", T.LongType(), False),
    T.StructField("exchange", T.StringType(), False),
    T.StructField("trade_condition", T.StringType(), False),
    T.StructField("data_quality_flag", T.StringType(), False),
])

QUOTES = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("bid_price", T.DoubleType(), False),
    T.StructField("ask_price", T.DoubleType(), False),
    T.StructField("bid_size", T.LongType(), False),
    T.StructField("ask_size", T.LongType(), False),
    T.StructField("exchange", T.StringType(), False),
    T.StructField("data_quality_flag", T.StringType(), False),
])

ORDER_BOOK = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("bid_prices", T.ArrayType(T.DoubleType()), False),
    T.StructField("bid_sizes", T.ArrayType(T.LongType()), False),
    T.StructField("ask_prices", T.ArrayType(T.DoubleType()), False),
    T.StructField("ask_sizes", T.ArrayType(T.LongType()), False),
    T.StructField("mid_price", T.DoubleType(), False),
    T.StructField("weighted_mid", T.DoubleType(), False),
    T.StructField("book_imbalance", T.DoubleType(), False),  # Float32 upstream; kept lossless
    T.StructField("data_quality_flag", T.StringType(), False),
])

# The CSV form carries the four book arrays as JSON text.
ORDER_BOOK_CSV = T.StructType([
    f if not isinstance(f.dataType, T.ArrayType) else T.StructField(f.name, T.StringType(), False)
    for f in ORDER_BOOK.fields
])

ISSUES = T.StructType([
    T.StructField("detected_at", T.TimestampType(), False),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("event_time", T.TimestampType(), False),
    T.StructField("issue_type", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("details", T.StringType(), False),
])

ISSUE_COLUMNS = [f.name for f in ISSUES.fields]

RAW = {"trades": TRADES, "quotes": QUOTES, "order_book_snapshots": ORDER_BOOK}
RAW_CSV = {"trades": TRADES, "quotes": QUOTES, "order_book_snapshots": ORDER_BOOK_CSV}
