"""What the footers of the stored files tell: row counts, NULLs and extremes of whole days without reading a row."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import use_utc, work_folder, written
from barloom.sources import tables as tb

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet reads answer aggregates from footers; the caller's stays as it is."""
    other = use_utc(spark.newSession())
    sources = other.conf.get("spark.sql.sources.useV1SourceList").split(",")
    other.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources if s.strip() != "parquet"))
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"):
        other.conf.set(name, spark.conf.get(name))
    return other


def _columns(table: tb.Table) -> tuple[list[str], list[str]]:
    """Columns whose NULLs are counted, and those of whole numbers, whose extremes are kept."""
    fields = [f for f in table.schema.fields if f.name != tb.DAY]
    return [f.name for f in fields], [f.name for f in fields if isinstance(f.dataType, _WHOLE)]


def _held(table: tb.Table) -> list[Column]:
    return [F.count(F.lit(1)).alias("row_count"), *[F.count(n).alias(f"held_{n}") for n in _columns(table)[0]]]


def _extremes(table: tb.Table, of: bool = True) -> list[Column]:
    """Extremes of the columns themselves, or (``of`` false) of extremes already taken."""
    words = [(word, make, n) for n in _columns(table)[1] for word, make in (("least", F.min), ("greatest", F.max))]
    return [make(n if of else f"{word}_{n}").alias(f"{word}_{n}") for word, make, n in words]


def _profile_schema(table: tb.Table) -> T.StructType:
    names, whole = _columns(table)
    extremes = [T.StructField(f"{word}_{n}", table.schema[n].dataType) for n in whole for word in ("least", "greatest")]
    counts = [T.StructField(n, T.LongType()) for n in ("row_count", *[f"null_{n}" for n in names])]
    return T.StructType([T.StructField(tb.DAY, T.DateType()), *counts, *extremes])


def footer_counts(spark: SparkSession, root: str, table: tb.Table) -> DataFrame:
    """(trading_date, batch, row_count, held_…) of every batch, finished or not, from footers alone."""
    return tb.stored(_footer_session(spark), root, table).groupBy(tb.DAY, tb.BATCH).agg(*_held(table))


def footer_extremes(spark: SparkSession, root: str, table: tb.Table, without: list[dt.date]) -> DataFrame:
    """(trading_date, batch, least_…, greatest_…) from footers alone, of all days but some.

    Spark refuses extremes of a row group without a value, so days on which such a column has a NULL must be left out.
    """
    rows = tb.stored(_footer_session(spark), root, table)
    rows = rows.where(~F.col(tb.DAY).isin(without)) if without else rows
    return rows.groupBy(tb.DAY, tb.BATCH).agg(*_extremes(table))


def _written(spark: SparkSession, found: DataFrame) -> DataFrame:
    """Written by the session that reads footers and read by the caller's, as plans of two sessions do not mix."""
    path = work_folder(spark, "footers")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def day_profile(spark: SparkSession, root: str, table: tb.Table) -> DataFrame:
    """One row per day that a table by day has rows of: row_count, null_… of each column, least_… and greatest_… of whole numbers.

    Most days are told by footers. Rows are read of days that several batches share, as batches may replace each other's keys,
    and of days on which a column of whole numbers has a NULL.
    """
    if table.day is None:
        raise ValueError(f"{table.name} has no days")
    batches = tb.visible(use_utc(spark), root, table).where("row_count > 0")
    if batches.isEmpty():
        return spark.createDataFrame([], _profile_schema(table))
    shared = batches.groupBy(tb.DAY).agg(F.count("*").alias("n")).where((F.col("n") > 1) & F.lit(bool(table.key))).select(tb.DAY)
    names, whole = _columns(table)
    counts = _written(spark, footer_counts(spark, root, table))
    unclear = reduce(lambda a, n: a | (F.col(f"held_{n}") < F.col("row_count")), whole, F.lit(False))
    with_nulls = counts.where(unclear).select(tb.DAY).distinct()
    to_read = written(shared.union(with_nulls).distinct(), "days-to-read")
    on = [tb.DAY, tb.BATCH]
    told = counts.join(batches.select(*on), on, "left_semi").join(to_read, tb.DAY, "left_anti")
    if whole:
        told = told.join(_written(spark, footer_extremes(spark, root, table, tb.list_days(with_nulls))), on)
    rows = tb.with_day(tb.read_table(spark, root, table, to_read), table)
    rows = rows.groupBy(tb.DAY).agg(*_held(table), *_extremes(table))
    held = [F.sum(c).alias(c) for c in ("row_count", *[f"held_{n}" for n in names])]
    merged = told.drop(tb.BATCH).unionByName(rows).groupBy(tb.DAY).agg(*held, *_extremes(table, of=False))
    return merged.select(
        tb.DAY,
        "row_count",
        *[(F.col("row_count") - F.col(f"held_{n}")).alias(f"null_{n}") for n in names],
        *[f"{word}_{n}" for n in whole for word in ("least", "greatest")],
    )
