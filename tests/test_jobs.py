"""Whole jobs over tables on disk."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.operators import quality, reports
from barloom.__main__ import arguments, main
from barloom.plans import load as jobs
from barloom.plans import publish, serve
from barloom.session import work_folder
from barloom.sources import footers
from barloom.sources import tables as tb
from barloom.sources.payloads import read_landing
from barloom.streaming.ingest import start_ingest, write_batch
from tests.conftest import bar
from tests.payload_samples import payload

AS_OF = dt.date(2026, 4, 10)
E2E = payload("E2E_SMOKE", {"2026-04-07": (200, 215, 198, 210, 2000), "2026-04-06": (100, 112, 95, 110, 1000)})


def texts(spark, *values):
    rows = [v if isinstance(v, tuple) else (v, dt.date(2026, 4, 8), "f") for v in values]
    return spark.createDataFrame(rows, "value string, run_date date, file string")


@pytest.fixture(scope="module", autouse=True)
def quick_plans(spark):
    """The jobs run many tiny plans here: interpreting them is quicker than compiling them."""
    quick = {
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.sql.shuffle.partitions": "1",
    }
    before = {name: spark.conf.get(name) for name in quick}
    for name, value in quick.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


def read(spark, root, table):
    return tb.read_table(spark, root, table)


def batches(spark, root):
    return {r[0] for r in tb.finished(spark, root).select("batch").collect()}


def marks(spark, root):
    return {r["symbol"]: (r["last_watermark"].date(), r["last_row_count"], r["status"]) for r in
            read(spark, root, tb.LOAD_STATE).collect()}


def test_gated_run_end_to_end(spark, root):
    run = publish.run_gated(spark, root, texts(spark, E2E), AS_OF)
    assert run.status == "success" and len(run.steps) == 3
    assert read(spark, root, tb.BARS).count() == 2
    assert marks(spark, root) == {"E2E_SMOKE": (dt.date(2026, 4, 7), 2, "success")}
    assert read(spark, root, tb.LOAD_AUDIT).first()["record_count"] == 2
    latest = reports.serve_latest(read(spark, root, tb.LATEST_PRICE)).first()
    assert (latest["latest_ts"].date(), float(latest["close_price"]), latest["volume"]) == (dt.date(2026, 4, 7), 210, 2000)
    day = read(spark, root, tb.DAILY_SUMMARY).where("trading_date = '2026-04-06'").first()
    assert (float(day["avg_close"]), float(day["min_close"]), float(day["max_close"]), day["total_volume"]) == (110, 110, 110, 1000)
    assert read(spark, root, tb.VOLUME_RANK).where("trading_date = '2026-04-07'").first()["volume_rank"] == 1
    steps = read(spark, root, tb.STEP_RUNS).collect()
    assert {s["step_name"]: (s["status"], s["row_count"]) for s in steps} == {
        "run_stock_pipeline": ("success", 2),
        "run_quality_checks": ("success", 6),
        "build_marts": ("success", 2),
    }


def test_second_run_of_the_same_payload_changes_nothing(spark, root):
    first = jobs.load_incremental(spark, root, texts(spark, E2E))
    again = jobs.load_incremental(spark, root, texts(spark, E2E))
    assert first.row_count == 2 and again.batch is None and again.row_count == 0
    assert read(spark, root, tb.BARS).count() == 2
    assert read(spark, root, tb.LOAD_AUDIT).count() == 1
    assert batches(spark, root) == {first.batch}


def test_batches_in_time_order_equal_one_batch(spark, tmp_path):
    days = {f"2026-04-{d:02d}": (d, d, d, d, d) for d in range(1, 10)}
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    jobs.load_incremental(spark, one, texts(spark, payload("A", days)))
    for lo in (1, 4, 7):
        part = {k: v for k, v in days.items() if lo <= int(k[-2:]) < lo + 4}
        jobs.load_incremental(spark, many, texts(spark, payload("A", part)))
    a, b = read(spark, one, tb.BARS), read(spark, many, tb.BARS)
    assert a.count() == 9 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_late_rows_wait_for_a_backfill(spark, root):
    early = payload("A", {"2026-04-01": (1, 1, 1, 1, 1)})
    jobs.load_incremental(spark, root, texts(spark, payload("A", {"2026-04-03": (3, 3, 3, 3, 3)})))
    assert jobs.load_incremental(spark, root, texts(spark, early)).row_count == 0
    result = jobs.backfill(spark, root, texts(spark, early), dt.date(2026, 4, 1), dt.date(2026, 4, 3))
    assert result.row_count == 1
    assert read(spark, root, tb.BARS).count() == 2
    assert marks(spark, root)["A"][0] == dt.date(2026, 4, 3)


def test_backfill_resumes_and_leaves_empty_days_open(spark, root):
    src = texts(spark, payload("A", {"2026-01-01": (1, 1, 1, 1, 1), "2026-01-03": (3, 3, 3, 3, 3)}))
    start, end = dt.date(2026, 1, 1), dt.date(2026, 1, 3)
    assert jobs.backfill(spark, root, src, start, dt.date(2026, 1, 1)).row_count == 1
    changed = texts(spark, payload("A", {f"2026-01-0{d}": (9, 9, 9, 9, 9) for d in (1, 3)}))
    assert jobs.backfill(spark, root, changed, start, end).days == [dt.date(2026, 1, 3)]
    closes = {r["ts"].day: float(r["close"]) for r in read(spark, root, tb.BARS).collect()}
    assert closes == {1: 1.0, 3: 9.0}
    done = sorted(r["trading_date"].day for r in read(spark, root, tb.PROGRESS).collect())
    assert done == [1, 3]
    again = jobs.backfill(spark, root, changed, start, end)
    assert again.row_count == 0 and again.batch is None
    with pytest.raises(ValueError):
        jobs.backfill(spark, root, src, end, start)


def test_backfill_progress_is_per_symbol_and_selectable(spark, root):
    day = {"2026-01-02": (1, 1, 1, 1, 1)}
    both = texts(spark, payload("A", day), payload("b", day))
    d = dt.date(2026, 1, 2)
    assert jobs.backfill(spark, root, both, d, d, symbols=["a"]).row_count == 1
    assert jobs.backfill(spark, root, both, d, d).row_count == 1
    assert read(spark, root, tb.BARS).count() == 2


def test_backfill_records_days_found_in_the_facts(spark, root):
    src = texts(spark, payload("A", {"2026-01-02": (1, 1, 1, 1, 1)}))
    jobs.load_incremental(spark, root, src)
    d = dt.date(2026, 1, 2)
    assert jobs.backfill(spark, root, src, d, d).row_count == 0
    assert read(spark, root, tb.PROGRESS).count() == 1


def test_earlier_run_date_and_last_file_of_it_win(spark, root):
    old = (payload("A", {"2026-04-01": (1, 1, 1, 1, 1)}), dt.date(2026, 4, 2), "x")
    new = (payload("a", {"2026-04-01": (2, 2, 2, 2, 2)}), dt.date(2026, 4, 3), "x")
    again = (payload("A", {"2026-04-01": (3, 3, 3, 3, 3)}), dt.date(2026, 4, 2), "y")
    jobs.load_incremental(spark, root, texts(spark, new, old, again))
    assert [float(r["close"]) for r in read(spark, root, tb.BARS).collect()] == [3.0]


def test_run_dates_in_one_load_equal_one_load_each(spark, tmp_path):
    first = (payload("A", {"2026-04-01": (1, 1, 1, 1, 1), "2026-04-02": (1, 1, 1, 1, 1)}), dt.date(2026, 4, 2), "x")
    second = (payload("A", {"2026-04-02": (2, 2, 2, 2, 2), "2026-04-03": (2, 2, 2, 2, 2)}), dt.date(2026, 4, 3), "x")
    both, each = str(tmp_path / "both"), str(tmp_path / "each")
    jobs.load_incremental(spark, both, texts(spark, second, first))
    for delivery in (first, second):
        jobs.load_incremental(spark, each, texts(spark, delivery))
    closes = [sorted((r["ts"].day, float(r["close"])) for r in read(spark, r_, tb.BARS).collect()) for r_ in (both, each)]
    assert closes[0] == closes[1] == [(1, 1.0), (2, 1.0), (3, 2.0)]


def test_gate_blocks_the_marts_and_a_fix_opens_it(spark, root):
    bad = texts(spark, payload("A", {"2026-04-07": (1, 1, 1, -1, 5)}))
    run = publish.run_gated(spark, root, bad, AS_OF)
    assert run.status == "failed" and [s[2] for s in run.steps] == ["success", "failed"]
    assert "range on market_bars: Column close has 1 row(s) outside range min=0, max=None." in run.steps[1][6]
    assert read(spark, root, tb.DAILY_SUMMARY).count() == 0

    more = texts(spark, payload("A", {"2026-04-08": (1, 1, 1, 1, 5)}))
    assert publish.run_gated(spark, root, more, AS_OF).status == "failed", "the bad day is still unchecked"

    fixed = texts(spark, payload("A", {"2026-04-07": (1, 1, 1, 1, 5)}))
    assert tb.delete(spark, root, tb.BARS, F.col("close") < 0).days == [dt.date(2026, 4, 7)]
    day = dt.date(2026, 4, 7)
    assert jobs.backfill(spark, root, fixed, day, day).row_count == 1
    assert publish.run_gated(spark, root, fixed, AS_OF).status == "success"
    assert read(spark, root, tb.DAILY_SUMMARY).count() == 2


def test_gate_on_an_empty_table_fails_on_freshness_only(spark, root):
    report = publish.check_bars(spark, root, AS_OF).collect()
    assert {r["check_name"] for r in report if not r["passed"]} == {"freshness"}


def test_gate_reads_only_changed_days_but_judges_the_newest(spark, root):
    publish.run_gated(spark, root, texts(spark, E2E), AS_OF)
    assert publish.pass_gate(spark, root, AS_OF) == 6
    with pytest.raises(Exception, match="freshness on market_bars"):
        publish.pass_gate(spark, root, dt.date(2026, 6, 1))
    full = publish.check_bars(spark, root, AS_OF, full=True)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, publish.check_bars(spark, root, AS_OF).collect()))


def test_incremental_refresh_equals_a_full_one(spark, root, tmp_path):
    first = {f"2026-04-{d:02d}": (d, d, d, d, d) for d in range(1, 5)}
    second = {f"2026-04-{d:02d}": (d, d, d, d + 1, d) for d in range(4, 8)}
    jobs.load_incremental(spark, root, texts(spark, payload("A", first), payload("B", first)))
    assert len(publish.refresh_marts(spark, root)) == 4
    jobs.load_incremental(spark, root, texts(spark, payload("A", second)))
    d = dt.date(2026, 4, 2)
    assert publish.refresh_marts(spark, root) == [dt.date(2026, 4, n) for n in (5, 6, 7)]
    assert publish.refresh_marts(spark, root) == []
    names = {
        tb.DAILY_SUMMARY: ["created_at"],
        tb.LATEST_PRICE: ["updated_at"],
        tb.VOLUME_RANK: [],
    }
    step = {t: read(spark, root, t).drop(*drop).collect() for t, drop in names.items()}
    publish.refresh_marts(spark, root, full=True)
    for t, drop in names.items():
        assert sorted(map(tuple, read(spark, root, t).drop(*drop).collect())) == sorted(map(tuple, step[t]))


def one_bar(spark, symbol, day="2026-04-06", close=1):
    return spark.createDataFrame([bar(day, symbol, 1, 1, 1, close, 1)], tb.BARS.schema)


def test_unfinished_writes_stay_invisible(spark, root):
    jobs.load_incremental(spark, root, texts(spark, E2E))
    before = sorted(map(tuple, read(spark, root, tb.BARS).collect()))
    tb.write_rows(one_bar(spark, "JUNK"), root, tb.BARS, tb.new_batch())  # and then the job dies
    assert sorted(map(tuple, read(spark, root, tb.BARS).collect())) == before
    assert marks(spark, root) == {"E2E_SMOKE": (dt.date(2026, 4, 7), 2, "success")}
    later = payload("E2E_SMOKE", {"2026-04-09": (1, 1, 1, 1, 1)})
    assert jobs.load_incremental(spark, root, texts(spark, later)).row_count == 1
    assert read(spark, root, tb.BARS).where("symbol = 'JUNK'").isEmpty()
    assert read(spark, root, tb.BARS).count() == 3


def test_a_batch_tried_again_replaces_what_it_wrote(spark, root):
    batch = tb.new_batch()
    tb.write_rows(one_bar(spark, "A").unionByName(one_bar(spark, "B")), root, tb.BARS, batch)  # the job dies
    assert tb.write_rows(one_bar(spark, "A"), root, tb.BARS, batch) == 1
    tb.finish(spark, root, batch, {tb.BARS: False})
    assert [r["symbol"] for r in read(spark, root, tb.BARS).collect()] == ["A"]


def test_two_loads_at_once_lose_nothing(spark, root):
    """B has read the tables; A starts, finishes and reports success; B finishes: both are there."""
    b = tb.new_batch()
    tb.write_rows(one_bar(spark, "B"), root, tb.BARS, b)
    a = jobs.load_incremental(spark, root, texts(spark, E2E))
    tb.finish(spark, root, b, {tb.BARS: False})
    assert a.row_count == 2
    assert {r["symbol"] for r in read(spark, root, tb.BARS).collect()} == {"E2E_SMOKE", "B"}
    assert len(publish.refresh_marts(spark, root)) == 2


def files_of(root, table):
    return {str(p): p.stat().st_mtime_ns for p in Path(root, table.name).rglob("*.parquet")}


def test_delete_by_key_and_date_touches_no_other_day(spark, root):
    days = {f"2026-04-{d:02d}": (d, d, d, d, d) for d in range(1, 6)}
    jobs.load_incremental(spark, root, texts(spark, payload("A", days), payload("B", days)))
    publish.refresh_marts(spark, root)
    before = files_of(root, tb.BARS)
    keys = spark.createDataFrame([("A", bar("2026-04-02", "A", 1, 1, 1, 1, 1)[0]), ("A", None), (None, None)], "symbol string, ts timestamp")
    gone = tb.delete(spark, root, tb.BARS, keys=keys)
    assert (gone.row_count, gone.days) == (1, [dt.date(2026, 4, 2)])
    new = set(files_of(root, tb.BARS)) - set(before)
    assert before.items() <= files_of(root, tb.BARS).items() and all("trading_date=2026-04-02" in f for f in new)
    assert [r["symbol"] for r in read(spark, root, tb.BARS).where("ts = '2026-04-02'").collect()] == ["B"]

    newest = dt.date(2026, 4, 5)
    assert tb.delete(spark, root, tb.BARS, F.to_date("ts") == F.lit(newest)).row_count == 2
    assert newest not in tb.list_days(tb.days_held(spark, root, tb.BARS))
    assert read(spark, root, tb.BARS).count() == 7
    assert publish.refresh_marts(spark, root) == [dt.date(2026, 4, 2), newest]
    assert tb.delete(spark, root, tb.VOLUME_RANK, F.col(tb.DAY) == F.lit(newest), days=[newest]).row_count == 2
    leaders = serve.volume_leaders(spark, root, 2).collect()
    assert [(r["trading_date"].day, r["symbol"]) for r in leaders] == [(4, "A"), (4, "B")]
    assert tb.delete(spark, root, tb.BARS, F.col("symbol") == "nobody") == tb.Deleted(None, 0)
    assert tb.delete(spark, root, tb.BARS, F.lit(None).cast("boolean")) == tb.Deleted(None, 0)
    assert tb.delete(spark, root, tb.LATEST_PRICE, F.col("symbol") == "B").row_count == 1
    assert [r["symbol"] for r in serve.latest_price_listing(spark, root).collect()] == ["A"]
    assert [r["row_count"] for r in serve.symbol_coverage(spark, root).collect()] == [3, 4]
    assert tb.delete(spark, root, tb.BARS, F.lit(True)).row_count == 7 and read(spark, root, tb.BARS).count() == 0


def test_days_in_several_batches_have_one_row_a_key(spark, root):
    for symbol, close in (("A", 1), ("B", 1), ("A", 2), ("A", 3)):
        batch = tb.new_batch()
        tb.write_rows(one_bar(spark, symbol, close=close), root, tb.BARS, batch)
        tb.finish(spark, root, batch, {tb.BARS: False})
    rows = lambda: {r["symbol"]: int(r["close"]) for r in read(spark, root, tb.BARS).collect()}
    assert rows() == {"A": 3, "B": 1}
    assert tb.compact(spark, root, tb.BARS) == [dt.date(2026, 4, 6)] and tb.compact(spark, root, tb.BARS) == []
    assert rows() == {"A": 3, "B": 1} and tb.visible(spark, root, tb.BARS).count() == 1


def test_profiles_come_from_footers(spark, root):
    rows = [
        bar("2026-04-01T10:00", "A", None, 2, 1, 1, -5), bar("2026-04-01T11:00", "A", 1, 2, -1, 1, 7), bar("2026-04-01T11:00", "A", 1, 2, 1, 1, 8),
        bar("2026-04-02", "A", 1, 1, 1, None, None), bar("2026-04-03", "B", 1, 1, 1, 1, 3),
    ]
    first, again, died = tb.new_batch(), tb.new_batch(), tb.new_batch()
    tb.write_rows(spark.createDataFrame(rows, S.BARS), root, tb.BARS, first)
    tb.finish(spark, root, first, {tb.BARS: False})
    tb.write_rows(spark.createDataFrame([bar("2026-04-03", "B", 1, 1, 1, 1, 4), bar("2026-04-03", "C", 1, 1, 1, 1, -9)], S.BARS), root, tb.BARS, again)
    tb.finish(spark, root, again, {tb.BARS: False})
    tb.write_rows(spark.createDataFrame([bar("2026-04-04", "D", 1, 1, 1, 1, 1)], S.BARS), root, tb.BARS, died)
    conf = {name: spark.conf.get(name) for name in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    got = {r["trading_date"].day: r for r in footers.day_profile(spark, root, tb.BARS).collect()}
    assert {d: (r["row_count"], r["null_open"], r["null_close"], r["null_volume"], r["least_volume"], r["greatest_volume"]) for d, r in got.items()} == {
        1: (3, 1, 0, 0, -5, 8), 2: (1, 0, 1, 1, None, None), 3: (2, 0, 0, 0, -9, 4),
    }
    assert conf == {name: spark.conf.get(name) for name in conf}
    empty = footers.day_profile(spark, root + "-empty", tb.BARS)
    assert empty.count() == 0 and empty.columns == footers.day_profile(spark, root, tb.BARS).columns
    assert [r["value"] for r in publish.audit_stored(spark, root + "-empty").collect()] == [0] * 11
    plan = footers.footer_counts(spark, root, tb.BARS)._jdf.queryExecution().optimizedPlan().toString()
    assert "count(*)" in plan and "group_col_0" in plan
    audit = sorted(publish.audit_stored(spark, root).collect())
    assert audit == sorted(quality.bar_audit(read(spark, root, tb.BARS)).collect()) and [r["value"] for r in audit] == [6, 0, 0, 1, 0, 0, 1, 1, 1, 2, 1]
    check = publish.check_stored_freshness(spark, root, 3, AS_OF).first()
    assert (check["passed"], check["details"]) == tuple(quality.check_freshness(read(spark, root, tb.BARS), "market_bars", "ts", 3, AS_OF).first()[2::2])
    with pytest.raises(ValueError, match="no days"):
        footers.day_profile(spark, root, tb.LOAD_STATE)


def test_rejects_stay_after_later_loads(spark, root):
    now = dt.datetime(2026, 4, 8)
    bad = texts(spark, payload("A", {"2026-04-02": ("x", 1, 1, 1, 1)}))
    assert jobs.load_incremental(spark, root, bad, now=now).rejected == 1
    jobs.load_incremental(spark, root, bad, now=now)
    jobs.load_incremental(spark, root, texts(spark, E2E), now=now)
    assert [(r["symbol"], r["raw_date"], r["reject_reason"]) for r in read(spark, root, tb.REJECTS).collect()] == [
        ("A", "2026-04-02", "bad price")
    ]
    assert read(spark, root, tb.BARS).count() == 2


def test_late_rows_are_counted(spark, root):
    jobs.load_incremental(spark, root, texts(spark, payload("A", {"2026-04-03": (3, 3, 3, 3, 3)})))
    later = payload("A", {"2026-04-01": (1, 1, 1, 1, 1), "2026-04-03": (9, 9, 9, 9, 9)})
    result = jobs.load_incremental(spark, root, texts(spark, later))
    assert (result.row_count, result.late) == (0, 1)


def test_backfill_east_of_utc_leaves_no_gap(spark, root):
    days = {f"2026-04-{d}": (d, d, d, d, d) for d in (10, 11, 12)}
    text = payload("A", days, "Asia/Tokyo")
    jobs.load_incremental(spark, root, texts(spark, payload("A", {"2026-04-11": (11,) * 5}, "Asia/Tokyo")))
    start, end = dt.date(2026, 4, 10), dt.date(2026, 4, 12)
    assert jobs.backfill(spark, root, texts(spark, text), start, end).row_count == 2
    assert read(spark, root, tb.BARS).count() == 3
    assert sorted(r["trading_date"].day for r in read(spark, root, tb.PROGRESS).collect()) == [10, 11, 12]
    assert jobs.backfill(spark, root, texts(spark, text), start, end).row_count == 0


def test_newest_days_are_read_alone(spark, root):
    jobs.load_incremental(spark, root, texts(spark, E2E))
    jobs.load_incremental(spark, root, texts(spark, payload("E2E_SMOKE", {"2026-04-08": (1, 1, 1, 1, 1)})))
    assert tb.read_table(spark, root, tb.BARS, [dt.date(2026, 4, 8)]).count() == 1


def test_failed_write_moves_no_mark(spark, root, monkeypatch):
    def broken(*args):
        raise RuntimeError("storage gone")

    monkeypatch.setattr(tb, "finish", broken)
    with pytest.raises(RuntimeError):
        jobs.load_incremental(spark, root, texts(spark, E2E))
    monkeypatch.undo()
    assert read(spark, root, tb.LOAD_STATE).count() == 0 and read(spark, root, tb.BARS).count() == 0


def test_rejects_are_counted_or_fail_strictly(spark, root):
    mixed = texts(spark, payload("A", {"2026-04-01": (1, 1, 1, 1, 1), "2026-04-02": ("x", 1, 1, 1, 1)}))
    with pytest.raises(jobs.StagingError, match="bad price: 1"):
        jobs.load_incremental(spark, root, mixed, strict=True)
    assert read(spark, root, tb.BARS).count() == 0
    result = jobs.load_incremental(spark, root, mixed)
    assert (result.row_count, result.rejected) == (1, 1)


def test_seed_inserts_once(spark, root):
    seed = spark.createDataFrame([bar("2026-01-01", "TEST", 100, 110, 90, 105, 1000)], tb.BARS.schema).drop("source")
    assert jobs.seed_bars(spark, root, seed).row_count == 1
    assert jobs.seed_bars(spark, root, seed.withColumn("close", F.lit(1).cast("decimal(18,6)"))).row_count == 0
    row = read(spark, root, tb.BARS).first()
    assert (float(row["close"]), row["source"]) == (105.0, "alpha_vantage")


def land(folder, run_date, symbol, text):
    path = folder / f"run_date={run_date}" / f"symbol={symbol}"
    os.makedirs(path, exist_ok=True)
    (path / "stock.json").write_text(text)


def test_stream_gives_the_same_tables_as_batches(spark, root, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    land(landing, "2026-04-07", "A", payload("A", {"2026-04-06": (1, 1, 1, 1, 1)}))
    land(landing, "2026-04-07", "B", payload("B", {"2026-04-06": (2, 2, 2, 2, 2)}))

    def drain():
        query = start_ingest(spark, str(landing), root, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None

    drain()
    assert read(spark, root, tb.BARS).count() == 2
    land(landing, "2026-04-08", "A", payload("A", {"2026-04-06": (9, 9, 9, 9, 9), "2026-04-07": (3, 3, 3, 3, 3)}))
    drain()
    closes = {(r["symbol"], r["ts"].day): float(r["close"]) for r in read(spark, root, tb.BARS).collect()}
    assert closes == {("A", 6): 1.0, ("B", 6): 2.0, ("A", 7): 3.0}
    drain()
    assert read(spark, root, tb.LOAD_AUDIT).count() == 3


def bars_of_stream(spark, landing, folder, **options):
    query = start_ingest(spark, str(landing), f"{folder}/lake", f"{folder}/checkpoint", **options)
    query.awaitTermination(240)
    assert query.exception() is None
    return sorted((r["symbol"], r["ts"].day, float(r["close"])) for r in read(spark, f"{folder}/lake", tb.BARS).collect())


def test_stream_equals_the_batch_load_whatever_its_batches(spark, tmp_path):
    """Two files of one symbol and run date, whose later name is older, rejects, and two run dates."""
    landing = tmp_path / "landing"
    land(landing, "2026-04-07", "A", payload("A", {"2026-04-05": (5,) * 5, "2026-04-06": (6,) * 5}))
    os.rename(landing / "run_date=2026-04-07/symbol=A/stock.json", landing / "run_date=2026-04-07/symbol=A/z.json")
    land(landing, "2026-04-07", "A", payload("A", {"2026-04-05": (50,) * 5, "2026-04-04": (4,) * 5}))
    land(landing, "2026-04-07", "B", payload("B", {"2026-04-06": (2,) * 5, "2026-04-07": ("x", 1, 1, 1, 1)}))
    land(landing, "2026-04-08", "A", payload("A", {"2026-04-05": (9,) * 5, "2026-04-08": (8,) * 5}))
    for at, name in enumerate(sorted(landing.rglob("*.json"), key=lambda p: (p.parts[-3], p.name == "stock.json"))):
        os.utime(name, (1_700_000_000 + at, 1_700_000_000 + at))
    want = [("A", 4, 4.0), ("A", 5, 5.0), ("A", 6, 6.0), ("A", 8, 8.0), ("B", 6, 2.0)]
    batch = str(tmp_path / "batch")
    jobs.load_incremental(spark, batch, read_landing(spark, str(landing)))
    assert sorted((r["symbol"], r["ts"].day, float(r["close"])) for r in read(spark, batch, tb.BARS).collect()) == want
    for files in (None, 1):
        folder = tmp_path / f"stream{files}"
        assert bars_of_stream(spark, landing, folder, max_files=files) == want
        assert bars_of_stream(spark, landing, folder, max_files=files) == want
        assert read(spark, f"{folder}/lake", tb.REJECTS).count() == 1
        assert marks(spark, f"{folder}/lake")["A"][0] == dt.date(2026, 4, 8)


def test_a_stream_starts_from_the_stored_marks(spark, tmp_path):
    lake = str(tmp_path / "s" / "lake")
    jobs.load_incremental(spark, lake, texts(spark, payload("A", {"2026-04-06": (6,) * 5})))
    land(tmp_path / "landing", "2026-04-09", "A", payload("A", {"2026-04-05": (9,) * 5, "2026-04-07": (7,) * 5}))
    land(tmp_path / "landing", "2026-04-09", "C", payload("C", {"2026-04-05": (3,) * 5}))
    assert bars_of_stream(spark, tmp_path / "landing", tmp_path / "s") == [("A", 6, 6.0), ("A", 7, 7.0), ("C", 5, 3.0)]


def test_a_replayed_micro_batch_is_written_once(spark, root):
    rows = jobs.staging.parse_payloads(texts(spark, E2E))
    rows = rows.select("*", jobs.load_order(rows).alias("load_order")).drop("file")
    write = write_batch(root, "checkpoint", strict=False)
    for _ in range(2):
        write(rows, 7)
    assert read(spark, root, tb.BARS).count() == 2 and read(spark, root, tb.LOAD_AUDIT).count() == 1
    assert len(batches(spark, root)) == 1


def test_stored_reports(spark, root):
    days = {f"2026-04-{d:02d}": (d, d, d, d, d) for d in range(1, 6)}
    jobs.load_incremental(spark, root, texts(spark, payload("A", days), payload("B", days, **{"note": "x"})))
    publish.refresh_marts(spark, root)
    leaders = serve.volume_leaders(spark, root, 3).collect()
    assert [(r["trading_date"].day, r["symbol"], r["volume_rank"]) for r in leaders] == [(5, "A", 1), (5, "B", 1), (4, "A", 1)]
    ranges = serve.daily_close_range(spark, root, 3).collect()
    assert [(r["trading_date"].day, r["symbol"]) for r in ranges] == [(5, "A"), (5, "B"), (4, "A")]
    assert serve.latest_price(spark, root).first()["symbol"] == "A"
    assert [r["symbol"] for r in serve.latest_price_listing(spark, root).collect()] == ["A", "B"]
    assert [r["record_count"] for r in serve.recent_loads(spark, root).collect()] == [5, 5]
    assert serve.load_state(spark, root).count() == 2
    assert [r["row_count"] for r in serve.symbol_coverage(spark, root).collect()] == [5, 5]
    assert [float(r["change_pct"]) for r in serve.price_changes(spark, root, " b ", 2).collect()] == [25.0, 33.33]


def test_command_line(spark, tmp_path, root, capsys):
    land(tmp_path / "raw", "2026-04-08", "E2E_SMOKE", E2E)
    raw = str(tmp_path / "raw")
    main(["load", "--root", root, "--payloads", raw])
    main(["marts", "--root", root])
    main(["changes", "--root", root, "--symbol", "e2e_smoke"])
    main(["export", "--root", root, "--out", str(tmp_path / "snap")])
    main(["backfill", "--root", root, "--payloads", raw, "--start", "2026-04-06", "--end", "2026-04-07"])
    out = capsys.readouterr().out
    assert "row_count=2" in out and "days rebuilt: 2" in out and "90.91" in out and "row_count=0" in out
    assert main(["gated", "--root", root, "--payloads", raw, "--symbol", "none"]) == 1  # too old to be fresh
    assert '"status":"failed"' in capsys.readouterr().out
    main(["delete", "--root", root, "--symbol", "e2e_smoke", "--start", "2026-04-07"])
    assert "row_count=1, days=[datetime.date(2026, 4, 7)]" in capsys.readouterr().out
    for bad in (["load", "--root", root], ["delete", "--root", root], ["load", "--root", root, "--payloads", raw, "--run-date", "2026-04-06"], ["marts", "--root", root, "--symbol", "A"], ["backfill", "--root", root, "--payloads", raw, "--start", "2026-04-06"]):
        with pytest.raises(SystemExit):
            arguments(bad)


def test_command_line_lands_and_loads_by_run_date(spark, tmp_path, root, capsys):
    raw, landing = tmp_path / "in", str(tmp_path / "landing")
    for at, day in enumerate(("2026-04-06", "2026-04-07", "2026-04-08")):
        folder = raw / day
        os.makedirs(folder)
        (folder / "a.json").write_text(payload("A", {day: (at + 1,) * 5}))
        main(["land", "--payloads", str(folder), "--landing", landing, "--run-date", day])
    assert sorted(os.listdir(f"{landing}/run_date=2026-04-06")) == ["symbol=A"]
    main(["load", "--root", root, "--landing", landing, "--run-date", "2026-04-06"])
    main(["load", "--root", root, "--landing", landing, "--run-date", "2026-04-07", "--until", "2026-04-08"])
    (tmp_path / "seed.csv").write_text("ts,symbol,open,high,low,close,volume\n2026-04-01T00:00:00Z,S,1,1,1,1,5\n")
    main(["seed", "--root", root, "--bars", str(tmp_path / "seed.csv")])
    main(["objects", "--payloads", str(raw / "2026-04-06"), "--bucket", str(tmp_path / "store"), "--run-date", "2026-04-06"])
    out = capsys.readouterr().out
    assert out.count("row_count=1") == 2 and out.count("row_count=2") == 1 and "raw/alpha_vantage" in out
    assert {(r["symbol"], r["ts"].day) for r in read(spark, root, tb.BARS).collect()} == {("A", 6), ("A", 7), ("A", 8), ("S", 1)}
    assert os.path.isdir(tmp_path / "store/raw/alpha_vantage/symbol=A/date=2026-04-06")
    days = read_landing(spark, landing, dt.date(2026, 4, 7), dt.date(2026, 4, 7))
    assert days.count() == 1 and "PartitionFilters: [isnotnull(run_date" in days._jdf.queryExecution().executedPlan().toString()


def test_work_folder_is_the_one_the_cluster_names():
    class Conf:
        def get(self, name, default=None):
            return {"spark.checkpoint.dir": "s3a://shared/work/"}.get(name, default)

    class Session:
        conf = Conf()

    first, second = work_folder(Session(), "job"), work_folder(Session(), "job")
    assert first.startswith("s3a://shared/work/job-") and first != second
