"""Column layouts, keys and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 6)
MART_PRICE = T.DecimalType(16, 4)

BAR_KEY = ("ts", "symbol")
PRICE_COLUMNS = ("open", "high", "low", "close")

BARS = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", PRICE),
        T.StructField("high", PRICE),
        T.StructField("low", PRICE),
        T.StructField("close", PRICE),
        T.StructField("volume", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

# One raw provider payload. Maps rather than structs: the field names hold dots
# and blanks, and the dates are keys.
PAYLOAD = T.StructType(
    [
        T.StructField("Meta Data", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "Time Series (Daily)",
            T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())),
        ),
    ]
)

LOAD_STATE_KEY = ("source", "symbol")
LOAD_STATE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("last_watermark", T.TimestampType()),
        T.StructField("last_row_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

LOAD_AUDIT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("load_date", T.DateType()),
        T.StructField("version", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)

PROGRESS_KEY = ("source", "symbol", "trading_date")
PROGRESS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trading_date", T.DateType()),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("load_date", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("raw_date", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("load_order", T.StringType()),
    ]
)

SUMMARY_KEY = ("symbol", "trading_date")
DAILY_SUMMARY = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trading_date", T.DateType()),
        T.StructField("avg_close", MART_PRICE),
        T.StructField("min_close", MART_PRICE),
        T.StructField("max_close", MART_PRICE),
        T.StructField("total_volume", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

DAILY_COVERAGE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trading_date", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("first_ts", T.TimestampType()),
        T.StructField("latest_ts", T.TimestampType()),
    ]
)

LATEST_KEY = ("symbol",)
LATEST_PRICE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("latest_ts", T.TimestampType()),
        T.StructField("close_price", MART_PRICE),
        T.StructField("volume", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

VOLUME_RANK = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trading_date", T.DateType()),
        T.StructField("total_volume", T.LongType()),
        T.StructField("volume_rank", T.IntegerType()),
    ]
)

STEP_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("step_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

FINISHED = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("trading_date", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("replaces", T.BooleanType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)

CONSUMED = T.StructType(
    [
        T.StructField("consumer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("trading_date", T.DateType()),
        T.StructField("source_batch", T.StringType()),
    ]
)

CHECKS = T.StructType(
    [
        T.StructField("seq", T.IntegerType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("failed_rows", T.LongType()),
        T.StructField("details", T.StringType()),
    ]
)
CHECK_COLUMNS = ("check_name", "table_name", "passed", "failed_rows", "details")

# ---------------------------------------------------------------------------
# These must be exactly as written for results to agree.
# ---------------------------------------------------------------------------
DEFAULT_SOURCE = "alpha_vantage"
UNKNOWN_SOURCE = "unknown"
DEFAULT_ZONE = "US/Eastern"

META_FIELD = "Meta Data"
SERIES_FIELD = "Time Series (Daily)"
META_SYMBOL = "2. Symbol"
META_ZONE = "5. Time Zone"
SERIES_OPEN = "1. open"
SERIES_HIGH = "2. high"
SERIES_LOW = "3. low"
SERIES_CLOSE = "4. close"
SERIES_VOLUME = "5. volume"
SERIES_FIELDS = (SERIES_OPEN, SERIES_HIGH, SERIES_LOW, SERIES_CLOSE, SERIES_VOLUME)

REQUIRED_BAR_FIELDS = ("symbol", "ts", "open", "high", "low", "close", "volume")

RETRYABLE_ERRORS = ("timeout", "rate_limit", "connection", "temporary", "server_error")
NON_RETRYABLE_ERRORS = ("schema", "validation", "auth", "not_found", "bad_request")
RETRYABLE_STATUS_CODES = (429, 500, 502, 503, 504)

MAX_FRESHNESS_MINUTES = 1440
MAX_LATENCY_SECONDS = 300.0
MAX_FAILURE_RATE = 0.05
GATE_MAX_AGE_DAYS = 14
SUMMARY_SYMBOL_WIDTH = 10

NOT_NULL_DETAILS = "Column %s has %d NULL row(s)."
UNIQUE_DETAILS = "Column %s has %d duplicated value group(s)."
RANGE_DETAILS = "Column %s has %d row(s) outside range min=%s, max=%s."
FOREIGN_KEY_DETAILS = "%s.%s has %d row(s) missing from %s.%s."
FRESHNESS_DETAILS = "Latest %s is %d day(s) old; max allowed age is %d day(s)."
FRESHNESS_EMPTY_DETAILS = "Table %s has no timestamp data in %s."
MISSING_SYMBOL_MESSAGE = "Missing stock symbol in payload metadata."
