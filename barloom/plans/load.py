"""Load jobs: routine incremental loads and date-range backfills, for all symbols at once.

Each job writes what it read and typed to a staging folder of its batch and works from that: nothing is parsed twice, and a lost
executor costs a re-read, not a re-parse. It writes the bars it brings and no others; marks and audit rows
are taken from these. All becomes visible in one step at the end.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions.times import check_range
from barloom.operators import backfill as bf
from barloom.operators import incremental, staging
from barloom.operators.upsert import absent, last_per_key
from barloom.session import use_utc, written
from barloom.sources import tables as tb


class StagingError(RuntimeError):
    """Strict loading met entries that could not be typed."""


@dataclass(frozen=True)
class LoadResult:
    """``late``: rows passed over by the mark although the bars do not hold them; a backfill can bring them."""

    batch: str | None
    row_count: int
    days: list[dt.date] = field(default_factory=list)
    rejected: int = 0
    late: int = 0


def load_order(rows: DataFrame) -> Column:
    """Says which of a symbol's payloads comes last: by run date, then by file."""
    order = [c for c in ("run_date", "file") if c in rows.columns]
    return F.concat_ws("|", *order) if order else F.lit("")


def _stage(spark: SparkSession, root: str, payloads: DataFrame, batch: str, strict: bool) -> tuple[DataFrame, int]:
    """Type the payloads once and read them back, with the number of rejects."""
    parsed = staging.parse_payloads(payloads)
    keep = [*staging.BAR_COLUMNS, "zone", "raw_date", staging.REASON, *(["run_date"] if "run_date" in parsed.columns else [])]
    return keep_staged(spark, root, parsed.select(*keep, load_order(parsed).alias("load_order")), batch, strict)


def keep_staged(spark: SparkSession, root: str, staged: DataFrame, batch: str, strict: bool) -> tuple[DataFrame, int]:
    """Write typed rows to the staging folder of a batch and read them back; the write counts the rejects itself."""
    path = f"{root}/_staging/batch={batch}"
    counted, reason = Observation(), F.col(staging.REASON)
    counts = [F.count_if(reason == name).alias(name) for name in staging.REASONS]
    staged.observe(counted, *counts).write.mode("overwrite").parquet(path)
    found = {name: n for name, n in counted.get.items() if n}
    if strict and found:
        raise StagingError("; ".join(f"{name}: {found[name]}" for name in sorted(found)))
    return spark.read.schema(staged.schema).parquet(path), sum(found.values())


def add_bars(spark: SparkSession, root: str, rows: DataFrame, batch: str, now: dt.datetime, state: DataFrame | None = None) -> int:
    """Write the rows to load, one a key, and the marks and audit rows they give.

    ``state``: the marks to keep where they are later; those stored, if not given.
    """
    order = ["load_order", *[c for c in rows.columns if c not in (*S.BAR_KEY, "load_order")]]
    loaded = tb.write_rows(last_per_key(rows, S.BAR_KEY, order), root, tb.BARS, batch)
    if loaded:
        bars = tb.own_rows(spark, root, tb.BARS, batch)
        state = tb.read_table(spark, root, tb.LOAD_STATE) if state is None else state
        tb.write_rows(incremental.moved_marks(state, bars, F.lit(now).cast("timestamp")), root, tb.LOAD_STATE, batch)
        tb.write_rows(incremental.audit_rows(bars, batch, now.date()), root, tb.LOAD_AUDIT, batch)
    return loaded


BARS_ADDED = {tb.BARS: False, tb.LOAD_STATE: False, tb.LOAD_AUDIT: False}


def keep_rejects(spark: SparkSession, root: str, staged: DataFrame, batch: str, today: dt.date) -> dict[tb.Table, bool]:
    """Add the entries that could not be typed to the rejects of the day, each once."""
    columns = S.REJECTS.fieldNames()
    rows = staging.rejected(staged).withColumn("load_date", F.lit(today)).select(*columns).distinct()
    new = tb.write_rows(rows.exceptAll(tb.read_table(spark, root, tb.REJECTS, [today])), root, tb.REJECTS, batch)
    return {tb.REJECTS: False} if new else {}


def _of_symbols(rows: DataFrame, symbols: list[str] | None) -> DataFrame:
    return rows if symbols is None else rows.where(F.col("symbol").isin([s.strip().upper() for s in symbols]))


def _late(rows: DataFrame, root: str, state: DataFrame) -> int:
    """How many keys the marks pass over that the bars of the same days do not hold. The rows are read once."""
    passed = incremental.with_mark(rows, state).where(F.col("ts") <= F.col("last_watermark"))
    passed = written(passed.select(*S.BAR_KEY, F.to_date("ts").alias(tb.DAY)).distinct(), "passed-over")
    facts = tb.read_table(rows.sparkSession, root, tb.BARS, passed.select(tb.DAY).distinct())
    return absent(facts, passed, S.BAR_KEY).count()


def _days_of(spark: SparkSession, root: str, batch: str) -> list[dt.date]:
    return tb.list_days(tb.finished(spark, root).where((F.col("batch") == batch) & (F.col("table_name") == tb.BARS.name)))


def load_incremental(
    spark: SparkSession,
    root: str,
    payloads: DataFrame,
    strict: bool = False,
    now: dt.datetime | None = None,
    symbols: list[str] | None = None,
    count_late: bool = True,
) -> LoadResult:
    """Load every bar later than its symbol's mark, then move the marks.

    ``payloads`` has ``value`` and may have ``run_date`` and ``file``. A run date is one
    delivery: its bars count if they are later than the mark and than the symbol's bars of
    earlier run dates; within a run date the last file wins. Without run dates a load is a
    delivery. A delivery without new bars changes nothing but the rejects. ``count_late`` reads the keys of the
    bars of all days that the marks pass over.
    """
    use_utc(spark)
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    batch = tb.new_batch()
    staged, rejected = _stage(spark, root, payloads, batch, strict)
    changed = keep_rejects(spark, root, staged, batch, now.date()) if rejected else {}
    rows = _of_symbols(staging.accepted(staged).drop("zone"), symbols)
    state = tb.read_table(spark, root, tb.LOAD_STATE)
    new = incremental.filter_delivered if "run_date" in rows.columns else incremental.filter_new
    loaded = add_bars(spark, root, new(rows, state).drop("run_date"), batch, now)
    late = _late(rows, root, state) if count_late else 0
    if loaded:
        changed |= BARS_ADDED
    if changed:
        tb.finish(spark, root, batch, changed)
    if not loaded:
        return LoadResult(None, 0, [], rejected, late)
    return LoadResult(batch, loaded, _days_of(spark, root, batch), rejected, late)


def backfill(
    spark: SparkSession,
    root: str,
    payloads: DataFrame,
    start: dt.date,
    end: dt.date,
    symbols: list[str] | None = None,
    strict: bool = False,
    now: dt.datetime | None = None,
) -> LoadResult:
    """Load the bars of the days in the range that are not done yet, whatever the marks say.

    Days already in the fact table or in the recorded progress are skipped; a day that
    brings no bar stays open. All dates are days in the symbol's zone, the one its payloads
    give. Marks keep the later of the stored and the loaded time.
    """
    use_utc(spark)
    check_range(start, end)
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    batch = tb.new_batch()
    staged, rejected = _stage(spark, root, payloads, batch, strict)
    changed = keep_rejects(spark, root, staged, batch, now.date()) if rejected else {}
    rows = _of_symbols(staging.accepted(staged), symbols)
    zones = bf.symbol_zones(rows)

    calendar = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    recorded = tb.read_table(spark, root, tb.PROGRESS, calendar)
    # A zone's day overlaps the UTC day before or after.
    around = [start - dt.timedelta(days=1), *calendar, end + dt.timedelta(days=1)]
    stored = bf.zoned_dates(tb.read_table(spark, root, tb.BARS, around), zones, start, end)
    done = recorded.select(*S.PROGRESS_KEY).unionByName(stored.select(*S.PROGRESS_KEY)).distinct()
    selected = bf.pending_dates(bf.zoned_dates(rows.drop("zone"), zones, start, end), done).drop("trading_date")
    loaded = add_bars(spark, root, selected.drop("run_date"), batch, now)
    if loaded:
        changed |= BARS_ADDED

    brought = bf.zoned_dates(tb.own_rows(spark, root, tb.BARS, batch), zones, start, end).select(*S.PROGRESS_KEY)
    newly = done.unionByName(brought).distinct().join(recorded, list(S.PROGRESS_KEY), "left_anti")
    if tb.write_rows(newly, root, tb.PROGRESS, batch):
        changed[tb.PROGRESS] = False
    if changed:
        tb.finish(spark, root, batch, changed)
    # Without any: nothing loaded, nothing newly known to be done.
    told = batch if {*changed} - {tb.REJECTS} else None
    return LoadResult(told, loaded, _days_of(spark, root, batch) if loaded else [], rejected)


def seed_bars(spark: SparkSession, root: str, rows: DataFrame) -> LoadResult:
    """Add bars whose key is not there yet; known keys are left alone."""
    use_utc(spark)
    batch = tb.new_batch()
    rows = staging.with_source(rows, S.DEFAULT_SOURCE)
    rows = last_per_key(rows, S.BAR_KEY, [c for c in rows.columns if c not in S.BAR_KEY])
    stored = tb.read_table(spark, root, tb.BARS, rows.select(F.to_date("ts").alias(tb.DAY)).distinct())
    added = tb.write_rows(absent(stored, rows, S.BAR_KEY), root, tb.BARS, batch)
    if not added:
        return LoadResult(None, 0)
    tb.finish(spark, root, batch, {tb.BARS: False})
    return LoadResult(batch, added, _days_of(spark, root, batch))
