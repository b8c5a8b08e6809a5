"""Reading the bar table for export, and writing snapshots as CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.staging import BAR_COLUMNS


def export_bars(bars: DataFrame, symbol: str | None = None) -> DataFrame:
    """Bars of one symbol or of all, ordered by symbol and time.

    The order is a range partitioning on both columns, so one symbol may span many tasks.
    """
    if symbol is not None:
        bars = bars.where(F.col("symbol") == symbol)
    return bars.select(*BAR_COLUMNS).orderBy("symbol", "ts")


def snapshot_rows(
    bars: DataFrame, snapshot_id: str, symbol: str | None = None, ingested_at: Column | None = None
) -> DataFrame:
    stamped_at = F.current_timestamp() if ingested_at is None else ingested_at
    return (
        export_bars(bars, symbol)
        .withColumnRenamed("ts", "event_ts")
        .withColumn("snapshot_id", F.lit(snapshot_id))
        .withColumn("ingested_at", stamped_at)
    )


def export_snapshot(bars: DataFrame, path: str, symbol: str | None = None) -> str:
    """Write a snapshot folder of CSV files with headers; the folder's stem names the snapshot.

    File names follow the order of the rows, so the parts read in name order are sorted.
    """
    stem = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    snapshot_rows(bars, stem, symbol).write.mode("overwrite").option("header", True).csv(path)
    return path
