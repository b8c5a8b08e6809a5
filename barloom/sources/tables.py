"""The stored tables: plain Parquet folders, written batch by batch by one writer.

A batch is one run of a job. Its rows of a table go to partitions of their own
(``trading_date=…/batch=…``, or ``batch=…`` where a table has no days) by dynamic partition overwrite,
so a batch that is tried again replaces what it wrote and nothing else. When all its rows are
written, the batch adds its days and row counts to the table of finished batches, one file that Spark writes in one
step; readers semi-join that table, so what a job changes appears together or not at all. A load
only writes the rows it brings: where several batches have rows of one day, readers keep the last row of each
key. A batch that replaces days hides their earlier batches, as marts, deletes and ``compact`` do.

There is one writer at a time. Loads only add, so should two run at once none loses what the other finished.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import schemas as S
from barloom.operators.upsert import delete_keys, last_per_key
from barloom.session import written

DAY = "trading_date"
BATCH = "batch"


@dataclass(frozen=True)
class Table:
    """A table, parted by day where ``day`` names the column its days come from.

    Of rows with one ``key`` the last counts: by the columns ``latest``, then by batch. Without a key all rows count.
    Columns ``told`` are stored as text to tell that, and are no part of the table.
    """

    name: str
    schema: T.StructType = field(compare=False)
    day: str | None = None
    order: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    latest: tuple[str, ...] = ()
    told: tuple[str, ...] = ()


BARS = Table("market_bars", S.BARS, day="ts", order=("symbol", "ts"), key=S.BAR_KEY, latest=("load_order",), told=("load_order",))
LOAD_STATE = Table("pipeline_metadata", S.LOAD_STATE, key=S.LOAD_STATE_KEY, latest=("last_watermark",))
REJECTS = Table("load_rejects", S.REJECTS, day="load_date", key=tuple(S.REJECTS.fieldNames()))
LOAD_AUDIT = Table("load_metadata", S.LOAD_AUDIT, day="load_date", key=("id",))
PROGRESS = Table("backfill_progress", S.PROGRESS, day=DAY, order=("symbol",), key=S.PROGRESS_KEY)
DAILY_SUMMARY = Table("mart_daily_symbol_summary", S.DAILY_SUMMARY, day=DAY, order=("symbol",))
LATEST_PRICE = Table("mart_symbol_latest_price", S.LATEST_PRICE)
VOLUME_RANK = Table("mart_symbol_volume_rank", S.VOLUME_RANK, day=DAY, order=("symbol",))
DAILY_COVERAGE = Table("daily_symbol_coverage", S.DAILY_COVERAGE, day=DAY, order=("symbol",))
GATE_PASSES = Table("quality_gate_passes", S.CHECKS)
STEP_RUNS = Table("step_runs", S.STEP_RUNS, day="started_at")
CONSUMED = Table("consumed_batches", S.CONSUMED, key=tuple(S.CONSUMED.fieldNames()))


def new_batch() -> str:
    """An id that sorts by time and is nobody else's."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"


def finished(spark: SparkSession, root: str) -> DataFrame:
    """(batch, table_name, trading_date, row_count, replaces, finished_at) of every finished batch."""
    try:
        return spark.read.schema(S.FINISHED).parquet(f"{root}/_finished")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], S.FINISHED)


def visible(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """(trading_date, batch, row_count) of the finished batches of a table that no later one replaces."""
    replaced_by = F.max(F.when(F.col("replaces"), F.col(BATCH))).over(Window.partitionBy(DAY))
    mine = finished(spark, root).where(F.col("table_name") == table.name).withColumn("_base", replaced_by)
    return mine.where(F.col("_base").isNull() | (F.col(BATCH) >= F.col("_base"))).select(DAY, BATCH, "row_count")


def days_held(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The days of which a table has rows."""
    return visible(spark, root, table).groupBy(DAY).agg(F.sum("row_count").alias("n")).where("n > 0").select(DAY)


def newest_days(spark: SparkSession, root: str, table: Table, n: int) -> DataFrame:
    return days_held(spark, root, table).orderBy(F.desc(DAY)).limit(n)


def list_days(days: DataFrame) -> list[dt.date]:
    """Days on the driver: as many as the calendar has."""
    return sorted(row[0] for row in days.select(DAY).distinct().collect())


def stored(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """All rows of all batches, finished or not, with their day and batch."""
    names = table.schema.fieldNames()
    parts = [T.StructField(DAY, T.DateType())] if table.day is not None and DAY not in names else []
    told = [T.StructField(name, T.StringType()) for name in table.told]
    schema = T.StructType([*table.schema.fields, *told, *parts, T.StructField(BATCH, T.StringType())])
    return spark.read.schema(schema).parquet(f"{root}/{table.name}")


def _last(rows: DataFrame, table: Table) -> DataFrame:
    names = table.schema.fieldNames()
    if set(table.key) == set(names):
        return rows.select(*names).distinct()
    return last_per_key(rows.select(*names, *table.told, BATCH), table.key, [*table.latest, BATCH]).select(*names)


def read_table(
    spark: SparkSession, root: str, table: Table, days: DataFrame | Iterable[dt.date] | None = None
) -> DataFrame:
    """Content of a table; of the given days only, where ``days`` is given.

    Only days with rows in several batches are brought down to one row a key, and only their rows are shuffled for it.
    """
    names = table.schema.fieldNames()
    batches = visible(spark, root, table).where("row_count > 0")
    if isinstance(days, DataFrame):
        batches = batches.join(days.select(DAY), DAY, "left_semi")
    elif days is not None:
        batches = batches.where(F.col(DAY).isin(list(days)))
    of_day = F.count("*").over(Window.partitionBy(DAY))
    batches = batches.withColumn("_several", (of_day > 1) & F.lit(bool(table.key)))
    kinds = {row[0] for row in batches.select("_several").distinct().collect()}
    parts = []
    for several in sorted(kinds):
        mine = batches.where(F.col("_several") == several).select(DAY, BATCH)
        on = [DAY, BATCH] if table.day is not None else [BATCH]
        rows = stored(spark, root, table).join(mine.select(*on), on, "left_semi")
        parts.append(_last(rows, table) if several else rows.select(*names))
    if not parts:
        return spark.createDataFrame([], table.schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def with_day(df: DataFrame, table: Table) -> DataFrame:
    return df if table.day == DAY else df.withColumn(DAY, F.to_date(table.day))


def write_rows(df: DataFrame, root: str, table: Table, batch: str) -> int:
    """Write rows of a batch, which nobody sees before ``finish``; returns their number, counted by the write itself.

    Columns that the table does not have are left out.

    Rows are gathered by day with a rebalance, which splits a day that is too big for one
    task and joins small ones, and are sorted so that a symbol filter can skip row groups.
    """
    counted = Observation()
    told = [F.col(name) if name in df.columns else F.lit(None).cast("string").alias(name) for name in table.told]
    rows, parts = df.select(*table.schema.fieldNames(), *told), [BATCH]
    if table.day is not None:
        rows = with_day(rows, table).hint("rebalance", DAY).sortWithinPartitions(DAY, *table.order)
        parts = [DAY, BATCH]
    rows = rows.withColumn(BATCH, F.lit(batch)).observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    writer.parquet(f"{root}/{table.name}")
    return counted.get["rows"]


def own_rows(spark: SparkSession, root: str, table: Table, batch: str) -> DataFrame:
    """What a batch has written to a table, finished or not."""
    return stored(spark, root, table).where(F.col(BATCH) == batch).select(*table.schema.fieldNames())


def finish(spark: SparkSession, root: str, batch: str, changed: dict[Table, bool | DataFrame]) -> None:
    """Make a batch's rows visible, in all tables at once.

    ``changed`` says of each table whether the rows replace what it had of their days (of all of it, without days) or add to
    it; a DataFrame of days replaces those days, also such as have no rows any more.
    """
    entries = None
    for table, how in changed.items():
        rows = stored(spark, root, table).where(F.col(BATCH) == batch)
        if table.day is None:
            counts = rows.agg(F.count("*").alias("row_count")).withColumn(DAY, F.lit(None).cast("date"))
        else:
            counts = rows.groupBy(DAY).agg(F.count("*").alias("row_count"))
        if isinstance(how, DataFrame):
            counts = how.select(DAY).distinct().join(counts, DAY, "left").fillna(0, ["row_count"])
        mine = counts.select(
            F.lit(batch).alias("batch"),
            F.lit(table.name).alias("table_name"),
            DAY,
            "row_count",
            F.lit(how is not False).alias("replaces"),
            F.current_timestamp().alias("finished_at"),
        )
        entries = mine if entries is None else entries.unionByName(mine)
    entries.coalesce(1).write.mode("append").parquet(f"{root}/_finished")


def unread_batches(spark: SparkSession, root: str, table: Table, consumer: str) -> DataFrame:
    """(trading_date, source_batch) of a table that ``consumer`` has not worked on yet."""
    done = read_table(spark, root, CONSUMED).where((F.col("consumer") == consumer) & (F.col("table_name") == table.name))
    return _batches(spark, root, table).join(done, [DAY, "source_batch"], "left_anti")


def _batches(spark: SparkSession, root: str, table: Table) -> DataFrame:
    return visible(spark, root, table).select(DAY, F.col(BATCH).alias("source_batch"))


def unread(spark: SparkSession, root: str, table: Table, consumer: str, full: bool = False) -> DataFrame:
    """What ``consumer`` has not worked on yet; all of the table with ``full``.

    Written down, so that what is marked as consumed in the end is what was read.
    """
    return written(_batches(spark, root, table) if full else unread_batches(spark, root, table, consumer), "unread")


def consume(root: str, table: Table, consumer: str, read: DataFrame, batch: str) -> None:
    """Write down what ``unread`` gave, as part of a batch."""
    rows = read.select(F.lit(consumer).alias("consumer"), F.lit(table.name).alias("table_name"), DAY, "source_batch")
    write_rows(rows, root, CONSUMED, batch)


@dataclass(frozen=True)
class Deleted:
    batch: str | None
    row_count: int
    days: list[dt.date] = field(default_factory=list)


def delete(
    spark: SparkSession,
    root: str,
    table: Table,
    condition: Column | None = None,
    keys: DataFrame | None = None,
    days: Iterable[dt.date] | None = None,
) -> Deleted:
    """Delete rows of a table by a condition, or those whose values of the columns of ``keys`` are in it.

    Only days that lose rows are written again; others keep their files. A day without rows left is
    gone. A NULL condition or key deletes nothing. ``days`` limits what is read. Tables without days are written as a whole.
    """
    held = read_table(spark, root, table, days)
    if keys is not None:
        keys = keys.distinct()
        hit = held.join(keys, keys.columns, "left_semi")
    else:
        hit = held.where(F.coalesce(condition, F.lit(False)))
    by_day = [DAY] if table.day is not None else []
    lost = (with_day(hit, table) if by_day else hit).groupBy(*by_day).agg(F.count("*").alias("n"))
    lost = written(lost.where("n > 0"), "deleted")
    n = lost.agg(F.sum("n")).first()[0]
    if not n:
        return Deleted(None, 0)
    batch = new_batch()
    left = read_table(spark, root, table, lost if by_day else None)
    left = delete_keys(left, keys, keys.columns) if keys is not None else left.where(~F.coalesce(condition, F.lit(False)))
    write_rows(left, root, table, batch)
    finish(spark, root, batch, {table: lost if by_day else True})
    return Deleted(batch, n, list_days(lost) if by_day else [])


def compact(spark: SparkSession, root: str, table: Table, batches: int = 2) -> list[dt.date]:
    """Write days that ``batches`` or more batches share as one batch again; returns these days."""
    shared = visible(spark, root, table).groupBy(DAY).agg(F.count("*").alias("n")).where(F.col("n") >= batches)
    shared = written(shared.select(DAY), "shared-days")
    days = list_days(shared)
    if days:
        batch = new_batch()
        write_rows(read_table(spark, root, table, shared), root, table, batch)
        finish(spark, root, batch, {table: shared})
    return days
