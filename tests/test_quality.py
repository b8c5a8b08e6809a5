import datetime as dt

import pytest

from barloom.operators import quality as q
from tests.conftest import bar


def one(df):
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["check_name", "table_name", "passed", "failed_rows", "details"]
    return tuple(rows[0])


def test_not_null(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (None,)], "close int")
    assert one(q.check_not_null(df, "market_bars", "close")) == (
        "not_null", "market_bars", False, 3, "Column close has 3 NULL row(s).",
    )
    assert one(q.check_not_null(df.where("close = 1"), "market_bars", "close"))[2:4] == (True, 0)


def test_unique_counts_groups_and_nulls_group_together(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), (None,), (None,), ("b",)], "symbol string")
    assert one(q.check_unique(df, "t", ["symbol"])) == (
        "unique", "t", False, 2, "Column symbol has 2 duplicated value group(s).",
    )


def test_range(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (None,), (5.0,), (0.0,)], "close double")
    assert one(q.check_range(df, "t", "close", min_value=0))[2:] == (
        False, 2, "Column close has 2 row(s) outside range min=0, max=None.",
    )
    assert one(q.check_range(df, "t", "close", min_value=-2, max_value=5))[2] is True
    assert one(q.check_range(df, "t", "close", max_value=4))[3] == 1
    with pytest.raises(ValueError, match="At least one of min_value or max_value"):
        q.check_range(df, "t", "close")


@pytest.mark.parametrize("age, passed", [(3, True), (14, True), (20, False), (-5, True)])
def test_freshness(spark, age, passed):
    as_of = dt.date(2026, 4, 20)
    df = spark.createDataFrame([(dt.datetime(2026, 4, 20) - dt.timedelta(days=age),)], "ts timestamp")
    row = one(q.check_freshness(df, "t", "ts", 14, as_of))
    assert row[2:] == (passed, 0 if passed else 1, f"Latest ts is {age} day(s) old; max allowed age is 14 day(s).")
    empty = one(q.check_freshness(df.where("false"), "t", "ts", 14, as_of))
    assert empty[2:] == (False, 1, "Table t has no timestamp data in ts.")


def test_foreign_key_counts_child_rows(spark):
    orders = spark.createDataFrame([(1,), (7,), (7,), (None,)], "customer_id int")
    customers = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert one(q.check_foreign_key(orders, "orders", "customer_id", customers, "customers", "id")) == (
        "foreign_key", "orders", False, 2, "orders.customer_id has 2 row(s) missing from customers.id.",
    )
    assert one(q.check_foreign_key(orders.where("customer_id = 1"), "o", "customer_id", customers, "c", "id"))[2:4] == (True, 0)


def test_gate_and_audit(bars_of):
    rows = [
        bar("2026-04-19", "A", 1, 1, 1, 1, 1),
        bar("2026-04-19", "A", 1, 1, 1, 1, 1),
        bar("2026-04-18", None, 1, 1, -1, -1, -5),
        bar("2026-04-17", "B", None, 1, 1, None, None),
    ]
    df = bars_of(rows)
    gate = q.bar_gate(df, as_of=dt.date(2026, 4, 20)).orderBy("seq").collect()
    assert [(r["check_name"], r["passed"], r["failed_rows"]) for r in gate] == [
        ("not_null", False, 1),
        ("not_null", True, 0),
        ("unique", False, 1),
        ("range", False, 1),
        ("range", False, 1),
        ("freshness", True, 0),
    ]
    message = q.failure_message(q.bar_gate(df, as_of=dt.date(2026, 4, 20))).first()
    assert message["failed_checks"] == 4 and message["passed"] is False
    with pytest.raises(q.QualityGateError) as raised:
        q.require_passed(gate)
    assert str(raised.value) == message["message"]
    assert str(raised.value).startswith("not_null on market_bars: Column symbol has 1 NULL row(s).; unique on")
    audit = {r["metric"]: r["value"] for r in q.bar_audit(df).collect()}
    assert len(audit) == 11
    assert audit == {
        "stock_rows_count": 4, "null_ts_count": 0, "null_symbol_count": 1, "null_open_count": 1,
        "null_high_count": 0, "null_low_count": 0, "null_close_count": 1, "null_volume_count": 1,
        "negative_price_count": 1, "negative_volume_count": 1, "duplicate_stock_key_groups": 1,
    }
    clean = q.bar_gate(df.where("volume = 1").limit(1), as_of=dt.date(2026, 4, 20)).collect()
    assert q.require_passed(clean) == 6
