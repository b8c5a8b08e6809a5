"""Run metrics and service-level reports over run-history tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.outcomes import ServiceLevels, failure_class, failure_rate, is_retryable_status, violations
from barloom.functions.times import minutes_between, seconds_between

STEP_FIELDS = ("duration_seconds", "error_message", "finished_at", "row_count", "started_at", "status", "step_name")
RUN_FIELDS = ("duration_seconds", "finished_at", "pipeline_name", "started_at", "status", "steps")
SLA_FIELDS = ("data_freshness_minutes", "failure_rate", "passed", "pipeline_latency_seconds", "violations")
TIMES = ("started_at", "finished_at")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def step_metrics(steps: DataFrame) -> DataFrame:
    """Step runs with their duration; NULL while a step has not finished."""
    return steps.withColumn("duration_seconds", seconds_between(F.col("started_at"), F.col("finished_at")))


def _sorted_json(fields: tuple[str, ...], get: Callable[[str], Column]) -> Column:
    """JSON object with the fields in the given, sorted order; NULLs are written out."""
    values = [(_iso(get(name)) if name in TIMES else get(name)).alias(name) for name in fields]
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"})


def step_json(steps: DataFrame) -> DataFrame:
    """Step runs with a ``json`` object of each."""
    return step_metrics(steps).withColumn("json", _sorted_json(STEP_FIELDS, F.col))


def run_json(runs: DataFrame) -> DataFrame:
    """Rows of ``run_metrics`` with a ``json`` object of each run and its steps."""

    def step(s: Column) -> Column:
        lasted = seconds_between(s.getField("started_at"), s.getField("finished_at"))
        values = {name: lasted if name == "duration_seconds" else s.getField(name) for name in STEP_FIELDS}
        return F.struct(*[(_iso(v) if name in TIMES else v).alias(name) for name, v in values.items()])

    listed = F.transform("steps", step)
    return runs.withColumn("json", _sorted_json(RUN_FIELDS, lambda name: listed if name == "steps" else F.col(name)))


def sla_json(report: DataFrame) -> DataFrame:
    """Rows of ``sla_report`` with a ``json`` object of each."""
    return report.withColumn("json", _sorted_json(SLA_FIELDS, F.col))


def run_metrics(steps: DataFrame, name: str) -> DataFrame:
    """One row per run: status, times, and its steps in order.

    A run has the few steps of the gated run, so its step list is short.
    """
    listed = F.array_sort(F.collect_list(F.struct("started_at", "step_name", "status", "finished_at", "row_count",
                                                  "error_message")))
    runs = steps.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        F.when(F.bool_or(F.col("status") == "failed"), "failed").otherwise("success").alias("status"),
        listed.alias("steps"),
    )
    return runs.select(
        "run_id",
        F.lit(name).alias("pipeline_name"),
        "status",
        "started_at",
        "finished_at",
        seconds_between(F.col("started_at"), F.col("finished_at")).alias("duration_seconds"),
        "steps",
    )


def run_counts(history: DataFrame, *by: str) -> DataFrame:
    """Failed and total runs, per group or overall."""
    counts = [
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.count(F.lit(1)).alias("total_runs"),
    ]
    return history.groupBy(*by).agg(*counts) if by else history.agg(*counts)


def sla_report(facts: DataFrame, levels: ServiceLevels = ServiceLevels()) -> DataFrame:
    """Service-level report per row of run facts.

    Needs latest_data_at, checked_at, pipeline_started_at, pipeline_finished_at,
    failed_runs and total_runs; other columns are kept in front.
    """
    needed = ["latest_data_at", "checked_at", "pipeline_started_at", "pipeline_finished_at", "failed_runs", "total_runs"]
    kept = [c for c in facts.columns if c not in needed]
    measured = facts.select(
        *kept,
        minutes_between(F.col("latest_data_at"), F.col("checked_at")).alias("data_freshness_minutes"),
        seconds_between(F.col("pipeline_started_at"), F.col("pipeline_finished_at")).alias("pipeline_latency_seconds"),
        failure_rate(F.col("failed_runs"), F.col("total_runs")).alias("failure_rate"),
    )
    found = violations(
        F.col("data_freshness_minutes"), F.col("pipeline_latency_seconds"), F.col("failure_rate"), levels
    )
    judged = measured.withColumn("violations", found)
    return judged.withColumn("passed", F.size("violations") == 0)


def classify_failures(log: DataFrame, error_type: str = "error_type", status_code: str | None = None) -> DataFrame:
    out = log.withColumn("failure_class", failure_class(F.col(error_type)))
    if status_code is not None:
        out = out.withColumn("status_retryable", is_retryable_status(F.col(status_code)))
    return out
