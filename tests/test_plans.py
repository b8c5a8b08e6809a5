"""What the plans read and shuffle, on tables written by the jobs."""

import datetime as dt
import re

import pytest

from barloom.operators import incremental, marts, quality, reports
from barloom.operators.upsert import last_per_key, upsert
from barloom import schemas as S
from barloom.sources import tables as tb
from tests.conftest import bar


def executed(df):
    """The plan as run, when the session re-plans at run time."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "lake")
    rows = [bar(f"2026-04-{d:02d}", f"S{i}", i, i, i, i, i * d) for d in range(1, 11) for i in range(1, 8)]
    df = spark.createDataFrame(rows, S.BARS)
    first = tb.new_batch()
    tb.write_rows(df, root, tb.BARS, first)
    tb.finish(spark, root, first, {tb.BARS: False})
    return root


@pytest.fixture
def bars(spark, lake):
    """The stored bars as one plain scan."""
    return spark.read.schema(S.BARS).parquet(f"{lake}/{tb.BARS.name}")


def test_symbol_report_filters_in_the_scan_and_never_sorts_the_history(bars):
    plan = planned(reports.recent_price_changes(bars, "S3", 5))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(symbol,S3\)", plan)
    assert "open" not in re.search(r"ReadSchema: (.*)", plan).group(1)
    below_window = plan[plan.index("Window") :]
    assert "TakeOrderedAndProject(limit=6" in below_window


def test_top_k_reports_use_a_top_k_operator(bars):
    assert "TakeOrderedAndProject(limit=20" in planned(reports.daily_close_range(marts.daily_summary(bars)))
    assert "TakeOrderedAndProject(limit=1" in planned(reports.serve_latest(marts.latest_price(bars)))


def test_aggregates_are_hash_based_and_partly_done_before_the_shuffle(bars):
    for df in (marts.daily_summary(bars), marts.latest_price(bars), reports.symbol_coverage(bars)):
        plan = planned(df)
        assert "SortAggregate" not in plan and "partial_" in plan
        assert "partial_" in plan[plan.index("Exchange hashpartitioning") :]


def test_uniqueness_reads_only_the_key(bars):
    plan = planned(quality.check_unique(bars, "market_bars", ["symbol", "ts"]))
    assert "ReadSchema: struct<ts:timestamp,symbol:string>" in plan


def test_gate_takes_two_scans_and_one_wide_shuffle(bars):
    plan = planned(quality.bar_gate(bars))
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_days_are_pruned_by_the_finished_batches(spark, lake):
    some = tb.read_table(spark, lake, tb.BARS, [dt.date(2026, 4, 3), dt.date(2027, 1, 1)])
    assert some.count() == 7
    plan = executed(some)
    assert re.search(r"PartitionFilters: \[trading_date#\d+ IN \(2026-04-03,2027-01-01\)", plan)
    assert "Aggregate" not in plan, "a day of one batch has one row a key"


def test_upsert_does_not_shuffle_the_target_for_a_small_batch(spark, bars):
    batch = last_per_key(bars.where("symbol = 'S1'"), S.BAR_KEY, ["source"])
    plan = executed(upsert(bars, batch, S.BAR_KEY))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_state_join_shuffles_when_the_state_is_too_big_to_broadcast(spark, bars):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = spark.createDataFrame([], S.LOAD_STATE)
        df = incremental.filter_new(bars, state.unionByName(incremental.advance_marks(
            state, bars, reports.F.lit(dt.datetime(2026, 1, 1)).cast("timestamp"))))
        assert "BroadcastHashJoin" not in executed(df) and df.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rank_is_one_plain_window_unless_a_day_is_large(bars):
    plan = executed(marts.volume_rank(marts.daily_summary(bars)))
    assert plan.count("FileScan") == 1 and plan.count("Window [") == 1 and "Union" not in plan


def test_written_days_are_sorted_and_balanced(spark, bars, tmp_path):
    plan = tb.with_day(bars, tb.BARS).hint("rebalance", tb.DAY)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [trading_date" in plan
    tb.write_rows(bars, str(tmp_path), tb.BARS, "b")
    for day in range(1, 11):
        path = f"{tmp_path}/market_bars/trading_date=2026-04-{day:02d}/batch=b"
        symbols = [r["symbol"] for r in spark.read.parquet(path).collect()]
        assert symbols == sorted(symbols) and len(symbols) == 7
