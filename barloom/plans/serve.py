"""Reports over the stored tables, reading no more than they need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.operators import reports
from barloom.plans.publish import MARTS_STEP
from barloom.session import use_utc
from barloom.sources import tables as tb


def _newest_days(spark: SparkSession, root: str, table: tb.Table, rows: int) -> DataFrame:
    """Enough of a by-day table for its ``rows`` newest rows: a day that is held has at least one row."""
    return tb.read_table(use_utc(spark), root, table, tb.newest_days(spark, root, table, rows))


def volume_leaders(spark: SparkSession, root: str, limit: int = 20) -> DataFrame:
    return reports.volume_leaders(_newest_days(spark, root, tb.VOLUME_RANK, limit), limit)


def daily_close_range(spark: SparkSession, root: str, limit: int = 20) -> DataFrame:
    return reports.daily_close_range(_newest_days(spark, root, tb.DAILY_SUMMARY, limit), limit)


def recent_loads(spark: SparkSession, root: str, limit: int = 10) -> DataFrame:
    return reports.recent_loads(_newest_days(spark, root, tb.LOAD_AUDIT, limit), limit)


def latest_price(spark: SparkSession, root: str) -> DataFrame:
    return reports.serve_latest(tb.read_table(use_utc(spark), root, tb.LATEST_PRICE))


def latest_price_listing(spark: SparkSession, root: str) -> DataFrame:
    return reports.latest_price_listing(tb.read_table(use_utc(spark), root, tb.LATEST_PRICE))


def load_state(spark: SparkSession, root: str) -> DataFrame:
    return reports.load_state_listing(tb.read_table(use_utc(spark), root, tb.LOAD_STATE))


def price_changes(spark: SparkSession, root: str, symbol: str, limit: int = 30) -> DataFrame:
    bars = tb.read_table(use_utc(spark), root, tb.BARS)
    return reports.recent_price_changes(bars, symbol.strip().upper(), limit)


def symbol_coverage(spark: SparkSession, root: str) -> DataFrame:
    """Coverage from the stored daily parts; of the bars only days that changed since the last refresh are read."""
    changed = tb.unread_batches(use_utc(spark), root, tb.BARS, MARTS_STEP).select(tb.DAY).distinct()
    fresh = reports.daily_coverage(tb.read_table(spark, root, tb.BARS, changed))
    stored = tb.read_table(spark, root, tb.DAILY_COVERAGE).join(changed, tb.DAY, "left_anti")
    return reports.merged_coverage(stored.unionByName(fresh))
