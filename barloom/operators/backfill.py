"""Date-range backfill as set operations: what is done, and what is left of a range.

Progress is kept per source, symbol and date, so one symbol's finished date does not
hide another's. What is done is folded into intervals of days, and what is left are the gaps between them: a plan has
as many rows as there are gaps, not as there are symbols and days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions.times import check_range, date_in_zone, utc_date


def day_intervals(dates: DataFrame) -> DataFrame:
    """(source, symbol, first_day, last_day): runs of days without a gap. A subject has as many dates as the calendar at most."""
    key = list(S.LOAD_STATE_KEY)
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("trading_date"))
    island = F.date_sub("trading_date", nth).alias("_island")
    runs = dates.select(*S.PROGRESS_KEY).distinct().select(*S.PROGRESS_KEY, island).groupBy(*key, "_island")
    return runs.agg(F.min("trading_date").alias("first_day"), F.max("trading_date").alias("last_day")).drop("_island")


def pending_intervals(subjects: DataFrame, done: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The days of the inclusive range that ``done`` (intervals) does not cover, as intervals of every source and symbol of ``subjects``.

    One window over the intervals: what is left lies between each one and the one before.
    """
    check_range(start, end)
    key = list(S.LOAD_STATE_KEY)
    after = F.lit(end + dt.timedelta(days=1))
    ends = subjects.select(*key).distinct().select(*key, after.alias("first_day"), after.alias("last_day"), F.lit(True).alias("_asked"))
    inside = done.where((F.col("last_day") >= F.lit(start)) & (F.col("first_day") <= F.lit(end)))
    every = inside.select(*key, "first_day", "last_day", F.lit(False).alias("_asked")).unionByName(ends)
    whole = Window.partitionBy(*key)
    before = F.lag("last_day").over(whole.orderBy("first_day", "last_day"))
    gaps = every.select(
        *key,
        F.date_add(F.coalesce(before, F.lit(start - dt.timedelta(days=1))), 1).alias("first_day"),
        F.date_sub("first_day", 1).alias("last_day"),
        F.max("_asked").over(whole).alias("_asked"),
    )
    return gaps.where(F.col("_asked") & (F.col("first_day") <= F.col("last_day"))).drop("_asked")


def days_of(intervals: DataFrame) -> DataFrame:
    """One row for each day of the intervals."""
    return intervals.select(*S.LOAD_STATE_KEY, F.explode(F.sequence("first_day", "last_day")).alias("trading_date"))


def symbol_zones(rows: DataFrame) -> DataFrame:
    """One zone per source and symbol: the first by name of those its payloads give."""
    return rows.groupBy(*S.LOAD_STATE_KEY).agg(F.min("zone").alias("zone"))


def zoned_dates(rows: DataFrame, zones: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Rows of the inclusive range with their ``trading_date`` in their symbol's zone; UTC where none is known."""
    known = zones.select(*S.LOAD_STATE_KEY, F.col("zone").alias("_zone"))
    dated = rows.join(known, list(S.LOAD_STATE_KEY), "left").withColumn(
        "trading_date", date_in_zone("ts", F.coalesce("_zone", F.lit("UTC")))
    )
    return dated.where(F.col("trading_date").between(F.lit(start), F.lit(end))).drop("_zone")


def loaded_dates(facts: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Distinct UTC dates present in the fact table, per source and symbol."""
    day = utc_date(F.col("ts"))
    if start is not None:
        facts = facts.where(F.col("ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        facts = facts.where(F.col("ts") < F.date_add(F.lit(end), 1).cast("timestamp"))
    return facts.select(*S.LOAD_STATE_KEY, day.alias("trading_date")).distinct()


def completed_dates(
    progress: DataFrame, facts: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Recorded progress together with the dates the fact table already holds."""
    return progress.select(*S.PROGRESS_KEY).unionByName(loaded_dates(facts, start, end)).distinct()


def pending_dates(spine: DataFrame, completed: DataFrame) -> DataFrame:
    return spine.join(completed, list(S.PROGRESS_KEY), "left_anti")


def rows_in_intervals(rows: DataFrame, pending: DataFrame, zone: Column | str) -> DataFrame:
    """Rows whose date, in their payload's zone, lies in a pending interval of their source and symbol."""
    gaps = pending.select(*[F.col(c).alias(f"_{c}") for c in S.LOAD_STATE_KEY], "first_day", "last_day")
    dated = rows.withColumn("_date", date_in_zone("ts", zone))
    same = F.lit(True)
    for c in S.LOAD_STATE_KEY:
        same = same & (F.col(c) == F.col(f"_{c}"))
    within = F.col("_date").between(F.col("first_day"), F.col("last_day"))
    return dated.join(gaps, same & within, "left_semi").drop("_date")


def rows_for_dates(rows: DataFrame, pending: DataFrame, zone: Column | str) -> DataFrame:
    """Rows whose date, in their payload's zone, is one of the pending dates."""
    dated = rows.withColumn("trading_date", date_in_zone("ts", zone))
    return dated.join(pending, list(S.PROGRESS_KEY), "left_semi").drop("trading_date")


def finished_dates(attempted: DataFrame, facts: DataFrame) -> DataFrame:
    """Attempted dates that did bring a fact row; the others stay open for the next run."""
    return attempted.join(loaded_dates(facts), list(S.PROGRESS_KEY), "left_semi")
