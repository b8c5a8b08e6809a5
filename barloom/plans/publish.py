"""Publication: quality gate, mart refresh, and the gated run that joins them to a load."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import marts, metrics, quality, reports
from barloom.plans.load import load_incremental
from barloom.session import use_utc, written
from barloom.sources import footers
from barloom.sources import tables as tb

# Step names as they appear in run records.
PIPELINE = "gated_run"
LOAD_STEP = "run_stock_pipeline"
GATE_STEP = "run_quality_checks"
MARTS_STEP = "build_marts"


def refresh_marts(spark: SparkSession, root: str, full: bool = False, now: dt.datetime | None = None) -> list[dt.date]:
    """Bring the three marts and the daily coverage up to date with the bars, in one step; returns the days rebuilt.

    Only days with batches of bars that no refresh has read are read and rewritten: a day's
    summary and ranks depend on that day alone, and a symbol's latest price can only be
    replaced by a bar of a changed day. ``full`` rebuilds from all bars.
    """
    use_utc(spark)
    stamp = F.lit(now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
    read = tb.unread(spark, root, tb.BARS, MARTS_STEP, full)
    days = tb.list_days(read)
    if not days:
        return []
    batch = tb.new_batch()
    changed = read.select(tb.DAY).distinct()
    bars = tb.read_table(spark, root, tb.BARS, changed)

    fresh = marts.fit_symbol(marts.daily_summary(bars))
    stored = tb.read_table(spark, root, tb.DAILY_SUMMARY, changed)
    tb.write_rows(marts.merge_summary(stored, fresh, stamp), root, tb.DAILY_SUMMARY, batch)

    latest = marts.advance_latest(tb.read_table(spark, root, tb.LATEST_PRICE), marts.latest_price(bars), stamp)
    tb.write_rows(latest, root, tb.LATEST_PRICE, batch)

    # Ranks need the merged summary, which has just been written.
    merged = tb.own_rows(spark, root, tb.DAILY_SUMMARY, batch)
    ranks = marts.merge_ranks(tb.read_table(spark, root, tb.VOLUME_RANK, changed), marts.volume_rank(merged))
    tb.write_rows(ranks, root, tb.VOLUME_RANK, batch)

    tb.write_rows(reports.daily_coverage(bars), root, tb.DAILY_COVERAGE, batch)

    tb.consume(root, tb.BARS, MARTS_STEP, read, batch)
    replaced = {tb.DAILY_SUMMARY: True, tb.LATEST_PRICE: True, tb.VOLUME_RANK: True, tb.DAILY_COVERAGE: changed}
    tb.finish(spark, root, batch, {**replaced, tb.CONSUMED: False})
    return days


def check_bars(
    spark: SparkSession, root: str, as_of: dt.date | None = None, full: bool = False, read: DataFrame | None = None
) -> DataFrame:
    """The gate's report on the bar table.

    Days without a batch that came after a gate last passed hold no failing rows and share no
    key with other days, so only changed days are read, and the last day for freshness.
    ``full`` reads them all. ``read``: the changed days, if they are known.
    """
    use_utc(spark)
    read = tb.unread(spark, root, tb.BARS, GATE_STEP, full) if read is None else read
    days = read.select(tb.DAY).unionByName(tb.newest_days(spark, root, tb.BARS, 1)).distinct()
    return quality.bar_gate(tb.read_table(spark, root, tb.BARS, days), as_of=as_of)


def pass_gate(spark: SparkSession, root: str, as_of: dt.date | None = None, full: bool = False) -> int:
    """Raise if the bars fail the gate; otherwise record the pass and return the number of checks."""
    read = tb.unread(spark, root, tb.BARS, GATE_STEP, full)
    report = check_bars(spark, root, as_of, full, read).collect()
    passed = quality.require_passed(report)
    batch = tb.new_batch()
    tb.write_rows(spark.createDataFrame(report, tb.GATE_PASSES.schema), root, tb.GATE_PASSES, batch)
    tb.consume(root, tb.BARS, GATE_STEP, read, batch)
    tb.finish(spark, root, batch, {tb.GATE_PASSES: True, tb.CONSUMED: False})
    return passed


def audit_stored(spark: SparkSession, root: str) -> DataFrame:
    """The eleven counts of ``quality.bar_audit`` over the stored bars.

    Rows and NULLs come from footers. Volumes are read of days only whose footers tell a negative one, of other days prices and
    keys alone.
    """
    profile = written(footers.day_profile(spark, root, tb.BARS), "profile")
    nulls = [f"null_{c}" for c in quality.AUDIT_NULLS]
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("row_count", *nulls)]
    told = profile.agg(*[s.alias(name) for s, name in zip(sums, quality.AUDIT_COUNTS)])
    bars = tb.read_table(spark, root, tb.BARS)
    low = tb.read_table(spark, root, tb.BARS, profile.where("least_volume < 0").select(tb.DAY))
    parts = [
        quality.audit_rows(told, quality.AUDIT_COUNTS[: len(sums)]),
        quality.audit_rows(bars.agg(quality.negative_prices()), ["negative_price_count"]),
        quality.audit_rows(low.agg(quality.negative_volumes()), ["negative_volume_count"]),
        quality.audit_duplicates(bars),
    ]
    return reduce(DataFrame.unionByName, parts)


def check_stored_freshness(
    spark: SparkSession, root: str, max_age_days: int, as_of: dt.date | None = None, table: tb.Table = tb.BARS
) -> DataFrame:
    """The freshness check of a table by day, from the days that finished batches hold: no stored row is read."""
    days = tb.days_held(use_utc(spark), root, table).withColumnRenamed(tb.DAY, table.day)
    return quality.check_freshness(days, table.name, table.day, max_age_days, as_of)


@dataclass
class GatedRun:
    run_id: str
    status: str = "running"
    steps: list[tuple] = field(default_factory=list)


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def run_step(run: GatedRun, name: str, work: Callable[[], int | None]) -> bool:
    """Do one step and note how it went; an error is noted, not raised."""
    started = _utc_now()
    try:
        rows, status, message = work(), "success", None
    except Exception as error:  # noted in the step record, which stops the run
        rows, status, message = None, "failed", str(error)
    run.steps.append((run.run_id, name, status, started, _utc_now(), rows, message))
    return status == "success"


def run_gated(
    spark: SparkSession,
    root: str,
    payloads: DataFrame,
    as_of: dt.date | None = None,
    strict: bool = False,
    symbols: list[str] | None = None,
    full: bool = False,
) -> GatedRun:
    """Load, check, publish; stop at the first step that fails. Step records are stored."""
    use_utc(spark)
    run = GatedRun(run_id=uuid.uuid4().hex)
    work = [
        (LOAD_STEP, lambda: load_incremental(spark, root, payloads, strict, symbols=symbols).row_count),
        (GATE_STEP, lambda: pass_gate(spark, root, as_of, full)),
        (MARTS_STEP, lambda: len(refresh_marts(spark, root))),
    ]
    for name, step in work:
        if not run_step(run, name, step):
            run.status = "failed"
            break
    else:
        run.status = "success"
    record_steps(spark, root, run)
    return run


def run_summary(spark: SparkSession, run: GatedRun) -> str:
    """A run and its steps as one JSON object."""
    steps = spark.createDataFrame(run.steps, tb.STEP_RUNS.schema)
    return metrics.run_json(metrics.run_metrics(steps, PIPELINE)).first()["json"]


def record_steps(spark: SparkSession, root: str, run: GatedRun) -> None:
    batch = tb.new_batch()
    tb.write_rows(spark.createDataFrame(run.steps, tb.STEP_RUNS.schema), root, tb.STEP_RUNS, batch)
    tb.finish(spark, root, batch, {tb.STEP_RUNS: False})
