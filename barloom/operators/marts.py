"""The analytical tables, each as a plan over the bars or over another mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions.times import utc_date
from barloom.operators.ordered import dense_rank_highest_first
from barloom.operators.upsert import upsert, upsert_keeping
from barloom.session import written


def _mean(name: str) -> Column:
    """Average at four places, rounded half up once: in whole units of the sum's six places."""
    units = f"cast(abs(sum({name})) * 1000000 as decimal(38,0))"
    places = F.expr(f"(2 * {units} + 100 * count({name})) div nullif(200 * count({name}), 0)").cast("decimal(20,0)")
    size = (places * F.lit("0.0001").cast("decimal(4,4)")).cast(S.MART_PRICE)
    return F.when(F.sum(name) < 0, -size).otherwise(size)


def daily_summary(bars: DataFrame) -> DataFrame:
    """Close-price statistics and total volume per symbol and UTC day.

    One aggregate with a map-side part, so a busy symbol or day is reduced before the shuffle.
    """
    return bars.groupBy("symbol", utc_date("ts").alias("trading_date")).agg(
        _mean("close").alias("avg_close"),
        F.min("close").cast(S.MART_PRICE).alias("min_close"),
        F.max("close").cast(S.MART_PRICE).alias("max_close"),
        F.sum("volume").alias("total_volume"),
    )


def fit_symbol(summary: DataFrame) -> DataFrame:
    """Fail on a symbol wider than the summary table's symbol column."""
    fits = F.coalesce(F.length("symbol") <= S.SUMMARY_SYMBOL_WIDTH, F.lit(True))
    message = F.concat(F.lit("symbol too long for the daily summary: "), "symbol")
    return summary.where(F.when(fits, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def latest_price(bars: DataFrame) -> DataFrame:
    """The last bar of each symbol.

    Fixed-width aggregate buffers, so this is a hash aggregate reduced map-side; no
    symbol's history is sorted. ``(ts, symbol)`` is the key of the bars, so there are no ties.
    """
    return bars.groupBy("symbol").agg(
        F.max("ts").alias("latest_ts"),
        F.max_by("close", "ts").cast(S.MART_PRICE).alias("close_price"),
        F.max_by("volume", "ts").alias("volume"),
    )


def volume_rank(summary: DataFrame) -> DataFrame:
    """Dense rank of the symbols of a day by volume, highest first. The summary is computed once, for sizes and ranks."""
    rows = written(summary.select("symbol", "trading_date", "total_volume"), "volumes")
    return dense_rank_highest_first(rows, "trading_date", "total_volume", "volume_rank")


def merge_summary(stored: DataFrame, fresh: DataFrame, now: Column) -> DataFrame:
    """Known days are replaced but keep ``created_at``; days that did not come again stay."""
    return upsert_keeping(stored, fresh, S.SUMMARY_KEY, {"created_at": now})


def merge_latest(stored: DataFrame, fresh: DataFrame, now: Column) -> DataFrame:
    return upsert(stored, fresh.withColumn("updated_at", now).select(*stored.columns), S.LATEST_KEY)


def advance_latest(stored: DataFrame, candidates: DataFrame, now: Column) -> DataFrame:
    """Merge the latest bars of only the changed days: a candidate counts if it is not older."""
    known = stored.select("symbol", F.col("latest_ts").alias("_known"))
    current = (
        candidates.join(known, "symbol", "left")
        .where(F.col("_known").isNull() | (F.col("latest_ts") >= F.col("_known")))
        .drop("_known")
    )
    return merge_latest(stored, current, now)


def merge_ranks(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    return upsert(stored, fresh.select(*stored.columns), S.SUMMARY_KEY)
