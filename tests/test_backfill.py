"""Intervals of done and pending days against days taken one by one."""

import datetime as dt
import random

from pyspark.sql import functions as F

from barloom.operators import backfill

START, END = dt.date(2026, 1, 1), dt.date(2026, 2, 10)


def day(n):
    return START + dt.timedelta(days=n)


def spread(df):
    return sorted(((r["symbol"] or "", r["trading_date"]) for r in backfill.days_of(df).collect()))


def test_gaps_are_what_is_not_done(spark):
    rng = random.Random(3)
    done = {(s, n) for s in ("A", "B", "C") for n in rng.sample(range(-9, 60), rng.choice([0, 5, 40]))}
    done |= {("D", n) for n in range(-5, 60)} | {("F", n) for n in range(5, 20)} | {("not asked", 3)}
    dates = spark.createDataFrame([("x", s, day(n)) for s, n in done] * 2, "source string, symbol string, trading_date date")
    subjects = spark.createDataFrame([("x", s) for s in ("A", "B", "C", "D", "E", "F", "A")], "source string, symbol string")
    gaps = backfill.pending_intervals(subjects, backfill.day_intervals(dates), START, END)
    days = (END - START).days + 1
    want = sorted((s, day(n)) for s in "ABCDEF" for n in range(days) if (s, n) not in done)
    assert spread(gaps) == want
    assert gaps.where("symbol in ('D', 'not asked')").isEmpty()
    assert [(r["first_day"], r["last_day"]) for r in gaps.where("symbol = 'F'").orderBy("first_day").collect()] == [
        (START, day(4)), (day(20), END)
    ]
    assert gaps.where("symbol = 'E'").count() == 1, "an untouched symbol is one row, whatever the range"
    assert spread(backfill.day_intervals(dates)) == sorted((s, day(n)) for s, n in done)


def test_rows_in_intervals_equal_rows_for_dates(spark):
    rng = random.Random(5)
    rows = spark.createDataFrame(
        [("x", rng.choice("AB"), dt.datetime(2026, 1, 1) + dt.timedelta(hours=rng.randrange(900))) for _ in range(200)],
        "source string, symbol string, ts timestamp",
    )
    dates = spark.createDataFrame([("x", s, day(n)) for s in "AB" for n in rng.sample(range(38), 20)], "source string, symbol string, trading_date date")
    for zone in ("UTC", "Asia/Tokyo"):
        want = backfill.rows_for_dates(rows, dates, F.lit(zone))
        got = backfill.rows_in_intervals(rows, backfill.day_intervals(dates), F.lit(zone))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 20
