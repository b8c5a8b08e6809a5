"""Loads that move a high-water mark per (source, symbol).

The mark is a stored maximum, compared strictly and kept for ever; it is not a
streaming watermark. The state side is joined without a hint: it is broadcast when its
measured size allows and shuffled otherwise, in which case a symbol that holds much of
the batch is split by the run-time skew handling.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import schemas as S


def with_mark(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows with the ``last_watermark`` of their source and symbol, NULL where none is stored."""
    marks = state.select(*S.LOAD_STATE_KEY, "last_watermark")
    return rows.join(marks, list(S.LOAD_STATE_KEY), "left")


def filter_new(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows later than their mark; all rows where there is no mark."""
    mark = F.col("last_watermark")
    fresh = with_mark(rows, state).where(mark.isNull() | (F.col("ts") > mark))
    return fresh.select(*rows.columns)


def _delivered(rows: DataFrame) -> DataFrame:
    """Rows with their run date; those without one come before all others."""
    return rows.withColumn("_run", F.coalesce("run_date", F.to_date(F.lit("0001-01-01"))))


def filter_delivered(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows later than their mark and than their symbol's rows of earlier run dates.

    A run date is one delivery, so the outcome is the same whether run dates come in one load or one after
    the other. Only a row per symbol and run date is windowed.
    """
    key = list(S.LOAD_STATE_KEY)
    each = _delivered(rows).groupBy(*key, "_run").agg(F.max("ts").alias("_max"))
    before = Window.partitionBy(*key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    marks = with_mark(each, state).select(
        *key, "_run", F.greatest("last_watermark", F.max("_max").over(before)).alias("_mark")
    )
    joined = _delivered(rows).join(marks, [*key, "_run"], "left")
    return joined.where(F.col("_mark").isNull() | (F.col("ts") > F.col("_mark"))).select(*rows.columns)


def late_rows(rows: DataFrame, state: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows a routine load passes over although the fact table does not hold them yet."""
    passed_over = with_mark(rows, state).where(F.col("ts") <= F.col("last_watermark"))
    return passed_over.join(facts.select(*S.BAR_KEY), list(S.BAR_KEY), "left_anti")


def batch_marks(rows: DataFrame) -> DataFrame:
    """Latest timestamp and row count of a batch, per source and symbol."""
    return rows.groupBy(*S.LOAD_STATE_KEY).agg(
        F.max("ts").alias("max_ts"), F.count(F.lit(1)).alias("row_count")
    )


def advance_marks(
    state: DataFrame, rows: DataFrame, updated_at: Column, status: str = "success"
) -> DataFrame:
    """State after a successful load of ``rows``. A mark never moves back."""
    loaded = F.col("max_ts").isNotNull()
    joined = state.join(batch_marks(rows), list(S.LOAD_STATE_KEY), "full_outer")
    return joined.select(
        *S.LOAD_STATE_KEY,
        F.greatest("last_watermark", "max_ts").alias("last_watermark"),
        F.coalesce("row_count", "last_row_count").alias("last_row_count"),
        F.when(loaded, F.lit(status)).otherwise(F.col("status")).alias("status"),
        F.when(loaded, updated_at).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def moved_marks(state: DataFrame, rows: DataFrame, updated_at: Column, status: str = "success") -> DataFrame:
    """The rows of the state that a successful load of ``rows`` changes. A mark never moves back."""
    stored = state.select(*S.LOAD_STATE_KEY, F.col("last_watermark").alias("_stored"))
    return batch_marks(rows).join(stored, list(S.LOAD_STATE_KEY), "left").select(
        *S.LOAD_STATE_KEY,
        F.greatest("_stored", "max_ts").alias("last_watermark"),
        F.col("row_count").alias("last_row_count"),
        F.lit(status).alias("status"),
        updated_at.alias("updated_at"),
    )


def audit_rows(rows: DataFrame, load_key: str, load_date: dt.date) -> DataFrame:
    """One audit row per source and symbol of a load.

    The id is a hash of the load and its subject, so writing the same load again gives
    the same row.
    """
    day = load_date.isoformat()
    return batch_marks(rows).select(
        F.md5(F.concat_ws("|", F.lit(load_key), "source", "symbol")).alias("id"),
        "source",
        F.lit(load_date).alias("load_date"),
        F.lit(day).alias("version"),
        F.col("row_count").alias("record_count"),
        F.lit(load_date).cast("timestamp").alias("recorded_at"),
    )
