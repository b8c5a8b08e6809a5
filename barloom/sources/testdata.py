"""Bars derived from the driver's Parquet tables.

The tables hold no market bars. Two groups of bars are derived from whole tables:
hourly bars per event type, and daily bars per supplier. This is an adapter for
test data, not an operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schemas as S

SHIPMENT_SOURCE = "shipments"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instants(df: DataFrame, *columns: str) -> DataFrame:
    """Zone-less timestamps read as UTC instants."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars: one symbol per event type, priced by the event value."""
    events = instants(table(spark, sf_dir, "events"), "ts").select(
        F.date_trunc("hour", "ts").alias("ts"),
        F.upper("event_type").alias("symbol"),
        "event_id",
        F.col("value").cast(S.PRICE).alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    return (
        events.groupBy("ts", "symbol")
        .agg(
            F.min_by("price", "event_id").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "event_id").alias("close"),
            F.sum("k").alias("volume"),
        )
        .withColumn("source", F.lit(S.DEFAULT_SOURCE))
    )


def user_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: one symbol per user, priced by the values of the user's events."""
    events = instants(table(spark, sf_dir, "events"), "ts").select(
        F.date_trunc("day", "ts").alias("ts"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        "event_id",
        F.col("value").cast(S.PRICE).alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    return events.groupBy("ts", "symbol").agg(
        F.min_by("price", "event_id").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "event_id").alias("close"),
        F.sum("k").alias("volume"),
        F.lit(S.DEFAULT_SOURCE).alias("source"),
    )


def shipment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar-shaped rows whose key repeats: one per order line, with the columns that order them."""
    lines = instants(table(spark, sf_dir, "lineitem"), "l_shipdate")
    price = F.col("l_extendedprice").cast(S.PRICE)
    return lines.select(
        F.col("l_shipdate").alias("ts"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        price.alias("open"),
        price.alias("high"),
        price.alias("low"),
        price.alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.lit(SHIPMENT_SOURCE).alias("source"),
        "l_orderkey",
        "l_linenumber",
    )


def shipment_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars, one symbol per supplier: opens at the first order's lowest line price, closes at the last
    order's highest."""
    orders = (
        shipment_rows(spark, sf_dir)
        .groupBy("ts", "symbol", "l_orderkey")
        .agg(F.min("close").alias("lowest"), F.max("close").alias("highest"), F.sum("volume").alias("quantity"))
    )
    return (
        orders.groupBy("ts", "symbol")
        .agg(
            F.min_by("lowest", "l_orderkey").alias("open"),
            F.max("highest").alias("high"),
            F.min("lowest").alias("low"),
            F.max_by("highest", "l_orderkey").alias("close"),
            F.sum("quantity").alias("volume"),
        )
        .withColumn("source", F.lit(SHIPMENT_SOURCE))
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived bars. ``(ts, symbol)`` is unique."""
    return event_bars(spark, sf_dir).unionByName(shipment_bars(spark, sf_dir))
