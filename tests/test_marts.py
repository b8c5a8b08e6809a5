import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.operators import marts, reports
from tests.conftest import bar

DAY = dt.date(2026, 4, 6)


def test_daily_summary(mart_bars):
    rows = {r["symbol"]: r for r in marts.daily_summary(mart_bars).collect()}
    a = rows["TESTA"]
    assert (a["trading_date"], a["avg_close"], a["min_close"], a["max_close"], a["total_volume"]) == (
        DAY,
        Decimal("11.5000"),
        Decimal("11.0000"),
        Decimal("12.0000"),
        300,
    )
    assert marts.daily_summary(mart_bars).schema["avg_close"].dataType == S.MART_PRICE


def test_latest_price(mart_bars):
    rows = {r["symbol"]: r for r in marts.latest_price(mart_bars).collect()}
    assert (rows["TESTA"]["latest_ts"].hour, rows["TESTA"]["close_price"], rows["TESTA"]["volume"]) == (
        11,
        Decimal("12.0000"),
        200,
    )


def test_volume_rank(mart_bars):
    ranks = marts.volume_rank(marts.daily_summary(mart_bars))
    got = [(r["symbol"], r["total_volume"], r["volume_rank"]) for r in ranks.orderBy("volume_rank").collect()]
    assert got == [("TESTA", 300, 1), ("TESTB", 120, 2)]
    assert dict(ranks.dtypes)["volume_rank"] == "int"


def test_merges_rerun_without_change(mart_bars):
    now = F.lit(dt.datetime(2026, 4, 7)).cast("timestamp")
    empty = mart_bars.sparkSession.createDataFrame([], S.DAILY_SUMMARY)
    once = marts.merge_summary(empty, marts.daily_summary(mart_bars), now)
    later = F.lit(dt.datetime(2026, 4, 8)).cast("timestamp")
    twice = marts.merge_summary(once, marts.daily_summary(mart_bars), later)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    assert twice.count() == 2

    stored = marts.merge_latest(mart_bars.sparkSession.createDataFrame([], S.LATEST_PRICE), marts.latest_price(mart_bars), now)
    assert marts.merge_latest(stored, marts.latest_price(mart_bars), later).count() == 2
    ranks = marts.volume_rank(once)
    assert marts.merge_ranks(ranks, marts.volume_rank(twice)).count() == 2


def test_advancing_ignores_older_candidates(spark, mart_bars, bars_of):
    now = F.lit(dt.datetime(2026, 4, 8)).cast("timestamp")
    stored = marts.merge_latest(spark.createDataFrame([], S.LATEST_PRICE), marts.latest_price(mart_bars), now)
    older = bars_of([bar("2026-04-05T10:00", "TESTA", 1, 1, 1, 1, 1), bar("2026-04-06T11:00", "TESTB", 1, 1, 1, 5, 5)])
    got = {r["symbol"]: r["close_price"] for r in marts.advance_latest(stored, marts.latest_price(older), now).collect()}
    assert got == {"TESTA": Decimal("12.0000"), "TESTB": Decimal("5.0000")}


def test_wide_symbol_fails(bars_of):
    wide = bars_of([bar("2026-04-06", "ABCDEFGHIJK", 1, 1, 1, 1, 1)])
    with pytest.raises(Exception, match="symbol too long"):
        marts.fit_symbol(marts.daily_summary(wide)).collect()


def test_price_changes_and_recent_report_agree(bars_of):
    closes = [100, 110, 0, 50, None, 70, "70.005"]
    rows = [bar(f"2026-04-0{i + 1}", "A", 1, 1, 1, c, i) for i, c in enumerate(closes)]
    df = bars_of(rows + [bar("2026-04-01", "B", 1, 1, 1, 9, 9)])
    got = {r["trading_date"].day: r for r in reports.price_changes(df).where("symbol = 'A'").collect()}
    assert got[1]["previous_close"] is None and got[1]["change_pct"] is None
    assert got[2]["change_pct"] == Decimal("10.00") and got[2]["price_change"] == Decimal("10")
    assert got[3]["change_pct"] == Decimal("-100.00")
    assert got[4]["price_change"] == Decimal("50") and got[4]["change_pct"] is None
    assert got[5]["price_change"] is None and got[6]["price_change"] is None
    assert got[7]["change_pct"] == Decimal("0.01")
    for limit in (1, 3, 7, 30):
        report = reports.recent_price_changes(df, "A", limit).collect()
        assert [r["trading_date"].day for r in report] == list(range(7, 0, -1))[:limit]
        assert all(tuple(r) == tuple(got[r["trading_date"].day]) for r in report)
    first = reports.chart_order(reports.recent_price_changes(df, "A", 3)).first()
    assert first["trading_date"].day == 5


def test_serving_one_row_also_when_empty(mart_bars):
    latest = marts.latest_price(mart_bars)
    row = reports.serve_latest(latest).collect()
    assert len(row) == 1 and row[0]["symbol"] == "TESTA" and row[0]["source"] == "database"
    empty = reports.serve_latest(latest.where("false")).collect()
    assert [tuple(r) for r in empty] == [(None, None, None, None, "database")]


def test_listings(mart_bars):
    summary = marts.daily_summary(mart_bars)
    leaders = reports.volume_leaders(marts.volume_rank(summary), 1).collect()
    assert [(r["symbol"], r["volume_rank"]) for r in leaders] == [("TESTA", 1)]
    ranges = reports.daily_close_range(summary).collect()
    assert [float(r["close_range"]) for r in ranges] == [1.0, 1.0]
    assert [(r["symbol"], r["row_count"]) for r in reports.symbol_coverage(mart_bars).collect()] == [
        ("TESTA", 2),
        ("TESTB", 2),
    ]
    assert [r["symbol"] for r in reports.recent_latest_prices(marts.latest_price(mart_bars)).collect()] == ["TESTA", "TESTB"]
    numbers = reports.bar_row_numbers(mart_bars).where("symbol = 'TESTA'").collect()
    assert sorted((r["ts"].hour, r["row_num"]) for r in numbers) == [(10, 2), (11, 1)]


def test_average_is_rounded_once(bars_of):
    # The exact mean, 1.00004999995, is below the half; rounded to ten places first it would not be.
    closes = ["1.000049", "1.000050", "1.000050"] * 6 + ["1.000051", "1.000049"]
    bars = bars_of([bar(f"2026-04-06T{i:02d}:00", "A", c, c, c, c, 1) for i, c in enumerate(closes)])
    from barloom.operators.marts import daily_summary

    row = daily_summary(bars).first()
    total = sum(Decimal(c) for c in closes)
    assert row["avg_close"] == (total / len(closes)).quantize(Decimal("0.0001"), rounding="ROUND_HALF_UP")
    assert daily_summary(bars_of([bar("2026-04-06", "A", None, None, None, None, 1)])).first()["avg_close"] is None
