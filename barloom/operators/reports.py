"""Listings and top-k reports read by people and by the serving layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.times import utc_date
from barloom.functions.values import percent_change
from barloom.operators.ordered import previous_value, row_numbers_latest_first

def bar_row_numbers(bars: DataFrame) -> DataFrame:
    """Every bar with its position from the latest bar of its symbol back."""
    return row_numbers_latest_first(bars.select("symbol", "ts", "close"), "symbol", "ts", "row_num")


def _changes(bars: DataFrame) -> DataFrame:
    return bars.select(
        "symbol",
        "ts",
        utc_date("ts").alias("trading_date"),
        F.col("close").alias("close_price"),
        "previous_close",
        (F.col("close") - F.col("previous_close")).alias("price_change"),
        percent_change(F.col("close"), F.col("previous_close")).alias("change_pct"),
        "volume",
    )


def price_changes(bars: DataFrame) -> DataFrame:
    """Change from the bar before, for every bar of every symbol."""
    rows = bars.select("symbol", "ts", "close", "volume")
    return _changes(previous_value(rows, "symbol", "ts", "close", "previous_close"))


def recent_price_changes(bars: DataFrame, symbol: str, limit: int = 30) -> DataFrame:
    """The latest ``limit`` bars of one symbol with their changes, latest first.

    A bar needs only the one before it, so the report takes the latest ``limit + 1`` bars
    by a top-k and compares those: the symbol's history is neither sorted nor gathered.
    """
    latest = (
        bars.where(F.col("symbol") == symbol)
        .select("symbol", "ts", "close", "volume")
        .orderBy(F.col("ts").desc())
        .limit(limit + 1)
    )
    before = Window.partitionBy("symbol").orderBy("ts")
    changed = latest.withColumn("previous_close", F.lag("close").over(before))
    return _changes(changed).orderBy(F.col("trading_date").desc(), F.col("ts").desc()).limit(limit)


def chart_order(changes: DataFrame) -> DataFrame:
    return changes.orderBy("trading_date", "ts")


def volume_leaders(ranks: DataFrame, limit: int = 20) -> DataFrame:
    return (
        ranks.select("trading_date", "symbol", "total_volume", "volume_rank")
        .orderBy(F.col("trading_date").desc_nulls_first(), "volume_rank", "symbol")
        .limit(limit)
    )


def latest_price_listing(latest: DataFrame) -> DataFrame:
    return latest.orderBy(F.col("latest_ts").desc_nulls_first(), "symbol")


def recent_latest_prices(latest: DataFrame, limit: int = 10) -> DataFrame:
    return latest_price_listing(latest).limit(limit)


def daily_close_range(summary: DataFrame, limit: int = 20) -> DataFrame:
    return (
        summary.select(
            "trading_date",
            "symbol",
            "avg_close",
            "min_close",
            "max_close",
            (F.col("max_close") - F.col("min_close")).alias("close_range"),
            "total_volume",
        )
        .orderBy(F.col("trading_date").desc_nulls_first(), "symbol")
        .limit(limit)
    )


def daily_coverage(bars: DataFrame) -> DataFrame:
    """Rows and time range of each symbol and day: parts that ``merged_coverage`` puts together."""
    return bars.groupBy("symbol", utc_date("ts").alias("trading_date")).agg(*_coverage(F.count(F.lit(1)), "ts", "ts"))


def merged_coverage(parts: DataFrame) -> DataFrame:
    return parts.groupBy("symbol").agg(*_coverage(F.sum("row_count"), "first_ts", "latest_ts")).orderBy("symbol")


def symbol_coverage(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(*_coverage(F.count(F.lit(1)), "ts", "ts")).orderBy("symbol")


def _coverage(rows: Column, first: str, latest: str) -> list[Column]:
    return [rows.alias("row_count"), F.min(first).alias("first_ts"), F.max(latest).alias("latest_ts")]


def recent_loads(audit: DataFrame, limit: int = 10) -> DataFrame:
    return audit.orderBy(F.col("recorded_at").desc_nulls_first(), "id").limit(limit)


def load_state_listing(state: DataFrame) -> DataFrame:
    return state.orderBy(F.col("updated_at").desc_nulls_first(), "source", "symbol")


def serve_latest(latest: DataFrame) -> DataFrame:
    """The newest price as exactly one row; all NULL when there is none."""
    fields = ["symbol", "latest_ts", "close_price", "volume"]
    newest = latest.select(*fields).orderBy(F.col("latest_ts").desc_nulls_first(), "symbol").limit(1)
    # An aggregate without groups gives its one row for no input, too.
    return newest.agg(*[F.first(c).alias(c) for c in fields]).withColumn("source", F.lit("database"))
