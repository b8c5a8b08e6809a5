import datetime as dt
import random

from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.operators import upsert as u
from barloom.operators import incremental as inc
from tests.conftest import bar, utc


def keyed(df):
    return {(r["ts"], r["symbol"]): (r["close"], r["volume"]) for r in df.collect()}


def test_last_row_of_a_batch_wins_also_for_a_hot_key(spark):
    rows = [(utc("2026-01-01"), "A" if i % 3 == 0 else f"S{i}", i, i * 10) for i in range(600)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "ts timestamp, symbol string, seq int, v int").repartition(6)
    got = {r["symbol"]: r["v"] for r in u.last_per_key(df, S.BAR_KEY, ["seq"]).collect()}
    want = {}
    for _, symbol, seq, v in sorted(rows, key=lambda r: r[2]):
        want[symbol] = v
    assert got == want


def test_upsert_replaces_keeps_and_is_idempotent(bars_of):
    stored = bars_of([bar("2026-01-01", "A", 1, 1, 1, 1, 1), bar("2026-01-02", "A", 1, 1, 1, 2, 2)])
    batch = bars_of([bar("2026-01-02", "A", 1, 1, 1, 9, None), bar("2026-01-03", "A", 1, 1, 1, 3, 3)])
    once = u.upsert(stored, batch, S.BAR_KEY)
    assert once.count() == 3
    assert keyed(u.upsert(once, batch, S.BAR_KEY)) == keyed(once)
    assert keyed(once)[(dt.datetime(2026, 1, 2), "A")][1] is None


def test_insert_if_absent_and_delete(bars_of):
    seed = bars_of([bar("2026-01-01", "TEST", 100, 110, 90, 105, 1000)])
    empty = seed.where("false")
    first = u.insert_if_absent(empty, seed, S.BAR_KEY)
    other = bars_of([bar("2026-01-01", "TEST", 1, 1, 1, 1, 1)])
    again = u.insert_if_absent(first, other, S.BAR_KEY)
    assert [float(r["close"]) for r in again.collect()] == [105.0]
    assert u.delete_rows(again, F.col("symbol") == "TEST").count() == 0
    assert u.delete_rows(again, F.col("symbol") == F.lit(None)).count() == 1


def test_carried_columns_keep_their_first_value(spark):
    schema = "k string, v int, created_at string"
    old = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], schema)
    new = spark.createDataFrame([("b", None), ("c", 3)], "k string, v int")
    got = u.upsert_keeping(old, new, ["k"], {"created_at": F.lit("now")})
    assert sorted(map(tuple, got.collect())) == [("a", 1, "old"), ("b", None, "old"), ("c", 3, "now")]


def state_of(spark, rows):
    return spark.createDataFrame(rows, S.LOAD_STATE)


def test_filter_is_strict_and_per_symbol(spark, bars_of):
    rows = bars_of([bar(f"2026-04-0{d}", s, 1, 1, 1, 1, 1) for d in (1, 2, 3) for s in ("A", "B")])
    state = state_of(spark, [("alpha_vantage", "A", utc("2026-04-02"), 2, "success", None)])
    got = sorted((r["symbol"], r["ts"].day) for r in inc.filter_new(rows, state).collect())
    assert got == [("A", 3), ("B", 1), ("B", 2), ("B", 3)]
    early = rows.where("ts <= '2026-04-02' AND symbol = 'A'")
    assert inc.filter_new(early, state).count() == 0


def test_marks_advance_but_never_fall(spark, bars_of):
    now = F.lit(dt.datetime(2026, 5, 1)).cast("timestamp")
    state = state_of(
        spark,
        [
            ("alpha_vantage", "A", utc("2026-04-14"), 2, "success", None),
            ("alpha_vantage", "B", utc("2026-04-20"), 7, "success", None),
            ("other", "A", utc("2026-01-01"), 1, "success", None),
        ],
    )
    batch = bars_of(
        [bar("2026-04-15", "A", 1, 1, 1, 1, 1), bar("2026-04-13", "A", 1, 1, 1, 1, 1), bar("2026-04-01", "B", 1, 1, 1, 1, 1)]
    )
    got = {(r["source"], r["symbol"]): (r["last_watermark"].day, r["last_row_count"]) for r in
           inc.advance_marks(state, batch, now).collect()}
    assert got == {("alpha_vantage", "A"): (15, 2), ("alpha_vantage", "B"): (20, 1), ("other", "A"): (1, 1)}


def test_late_rows_are_those_missing_below_the_mark(spark, bars_of):
    facts = bars_of([bar("2026-04-01", "A", 1, 1, 1, 1, 1), bar("2026-04-03", "A", 1, 1, 1, 1, 1)])
    state = state_of(spark, [("alpha_vantage", "A", utc("2026-04-03"), 2, "success", None)])
    batch = bars_of([bar(f"2026-04-0{d}", "A", 1, 1, 1, 1, 1) for d in (1, 2, 3, 4)])
    assert [r["ts"].day for r in inc.late_rows(batch, state, facts).collect()] == [2]
