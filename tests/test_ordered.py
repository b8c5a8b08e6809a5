"""The piecewise window operators against plain windows, on skewed data."""

import datetime as dt
import random

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import ordered


def skewed(spark, n=900, seed=3):
    """A third of the rows in one symbol, another share with a NULL symbol; unique times."""
    rng = random.Random(seed)
    start = dt.datetime(2026, 1, 1)
    times = rng.sample(range(0, 40 * 24 * 60), n)
    rows = []
    for i, minute in enumerate(times):
        symbol = "HOT" if i % 3 == 0 else (None if i % 7 == 0 else f"S{i % 20}")
        close = None if i % 11 == 0 else rng.randint(1, 50)
        rows.append((symbol, start + dt.timedelta(minutes=minute), close))
    return spark.createDataFrame(rows, "symbol string, ts timestamp, close int").repartition(5)


CASES = [0, 20, 100, 10**6]


@pytest.mark.parametrize("rows_per_task", CASES)
def test_row_numbers(spark, rows_per_task):
    df = skewed(spark)
    one_null = spark.createDataFrame([("HOT", None, 1)], df.schema)
    df = df.unionByName(one_null)
    w = Window.partitionBy("symbol").orderBy(F.col("ts").desc_nulls_first())
    want = df.withColumn("n", F.row_number().over(w).cast("bigint"))
    got = ordered.row_numbers_latest_first(df, "symbol", "ts", "n", rows_per_task)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("rows_per_task", CASES)
def test_previous_value(spark, rows_per_task):
    df = skewed(spark)
    w = Window.partitionBy("symbol").orderBy("ts")
    want = df.withColumn("p", F.lag("close").over(w))
    got = ordered.previous_value(df, "symbol", "ts", "close", "p", rows_per_task)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def ranks_agree(spark, rows, rows_per_task=0):
    df = spark.createDataFrame(rows, "d string, k int, v bigint")
    w = Window.partitionBy("d").orderBy(F.col("v").desc_nulls_first())
    want = df.withColumn("r", F.dense_rank().over(w))
    got = ordered.dense_rank_highest_first(df, "d", "v", "r", rows_per_task)
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_dense_rank_with_a_hot_day_and_hot_ties(spark):
    rng = random.Random(5)
    rows = []
    for k in range(1200):
        day = "hot" if k % 3 == 0 else f"d{k % 9}"
        volume = 0 if k % 4 == 0 else (None if k % 50 == 0 else rng.randint(0, 10 ** rng.randint(1, 17)))
        rows.append((day, k, volume))
    for rows_per_task in (0, 150, 10**6):
        assert ranks_agree(spark, rows, rows_per_task)


@settings(max_examples=4, deadline=None, phases=[Phase.generate])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]),
            st.integers(0, 1000),
            st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1), st.integers(-5, 5)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_dense_rank_any_values(spark, rows):
    assert ranks_agree(spark, rows, 2)


def test_dense_rank_of_a_large_group_of_nulls(spark):
    assert ranks_agree(spark, [("b", 0, None), ("b", 1, None), ("a", 0, 0), ("a", 0, 1)])


def run_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_row_windows_are_split_by_piece(spark):
    """Row-level windows are partitioned by piece as well as by group."""
    plan = run_plan(ordered.row_numbers_latest_first(skewed(spark), "symbol", "ts", rows_per_task=100))
    shuffles = [line for line in plan.splitlines() if "hashpartitioning(symbol" in line and "_piece" in line]
    assert shuffles


def test_nothing_is_cut_without_large_groups(spark):
    df = skewed(spark)
    for result in (
        ordered.row_numbers_latest_first(df, "symbol", "ts"),
        ordered.previous_value(df, "symbol", "ts", "close", "p"),
    ):
        plan = run_plan(result)
        assert "Union" not in plan, "the seed side is dropped at run time"
    ranked = run_plan(ordered.dense_rank_highest_first(df.withColumn("v", df.close.cast("bigint")), "symbol", "v", "r"))
    assert "Union" not in ranked


def largest_piece(df, group, key, rows_per_task):
    cut = ordered._cut(df, group, key, rows_per_task)
    return cut.where(F.col(ordered.PIECE).isNotNull()).groupBy(group, ordered.PIECE).count().agg(F.max("count")).first()[0]


def test_a_hot_minute_is_cut(spark):
    """A symbol's rows of one minute, more than a task should take, are dealt over several windows."""
    start = dt.datetime(2026, 1, 1)
    rows = [("HOT", start + dt.timedelta(microseconds=7 * i), i % 37) for i in range(9000)]
    rows += [("HOT", start + dt.timedelta(days=d), d) for d in range(1, 30)]
    rows += [("HOT", None, 1), (None, start, 1)] + [("COLD", start + dt.timedelta(days=d), d) for d in range(50)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, close int")
    assert largest_piece(df, "symbol", F.unix_micros("ts"), 60) <= 60
    latest = Window.partitionBy("symbol").orderBy(F.col("ts").desc_nulls_first())
    want = df.withColumn("n", F.row_number().over(latest).cast("bigint"))
    got = ordered.row_numbers_latest_first(df, "symbol", "ts", "n", rows_per_task=60)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    want = df.withColumn("p", F.lag("close").over(Window.partitionBy("symbol").orderBy(F.col("ts").asc_nulls_last())))
    got = ordered.previous_value(df, "symbol", "ts", "close", "p", rows_per_task=60)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_values_that_share_their_leading_digits_are_cut(spark):
    """Values that differ in their last 14 of 63 binary digits only; pieces hold no more than a task should take."""
    values = spark.range(12_000).select(F.lit("d").alias("d"), (F.lit(2**62) + F.col("id")).alias("v"))
    assert largest_piece(values, "d", F.col("v"), 500) <= 500
    rows = [("d", k, sign * (2**62 + k)) for k in range(2000) for sign in (1, -1)]
    rows += [("d", -1, None), ("d", -2, 0)]
    assert ranks_agree(spark, rows, 500)
    df = spark.createDataFrame(rows, "d string, k int, v bigint")
    plan = run_plan(ordered.dense_rank_highest_first(df, "d", "v", "r", 500))
    assert any("hashpartitioning(_large_group" in line and "_piece" in line for line in plan.splitlines())


def test_one_value_in_all_rows_ends_the_cutting(spark):
    df = spark.range(1000).select(F.lit("a").alias("g"), F.lit(7).cast("bigint").alias("v"))
    assert largest_piece(df, "g", F.col("v"), 10) == 1000
    assert ordered.dense_rank_highest_first(df, "g", "v", "r", 10).groupBy("r").count().collect() == [(1, 1000)]


def test_random_skew_equals_plain_windows(spark):
    rng = random.Random(11)
    for _ in range(3):
        spread = [10 ** rng.randint(2, 12) for _ in range(4)]
        times = {(f"S{int(rng.paretovariate(0.7)) % 9}", rng.randrange(rng.choice(spread))) for _ in range(2500)}
        df = spark.createDataFrame([(s, t, rng.randrange(9)) for s, t in times], "symbol string, us bigint, close int")
        df = df.select("symbol", F.timestamp_micros("us").alias("ts"), "close")
        want = df.withColumn("n", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("ts"))).cast("bigint"))
        got = ordered.row_numbers_latest_first(df, "symbol", "ts", "n", rows_per_task=rng.choice([3, 40, 300]))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        want = df.withColumn("p", F.lag("close").over(Window.partitionBy("symbol").orderBy("ts")))
        got = ordered.previous_value(df, "symbol", "ts", "close", "p", rows_per_task=rng.choice([3, 40, 300]))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_nothing_large_is_hinted_as_a_broadcast(spark):
    plan = ordered.row_numbers_latest_first(skewed(spark), "symbol", "ts", rows_per_task=100)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plan and "UnresolvedHint" not in plan
