import datetime as dt
import json

import pytest

from barloom.functions.outcomes import ServiceLevels
from barloom.operators import metrics as m
from barloom.schemas import STEP_RUNS

T0 = dt.datetime(2026, 4, 1, 10, 0, 0)


def steps(spark, *rows):
    return spark.createDataFrame(list(rows), STEP_RUNS)


def test_durations_and_json(spark):
    df = steps(
        spark,
        ("r", "load", "success", T0, T0 + dt.timedelta(seconds=1.25), 3, None),
        ("r", "check", "running", T0 + dt.timedelta(seconds=2), None, None, None),
    )
    rows = {r["step_name"]: r for r in m.step_json(df).collect()}
    assert rows["load"]["duration_seconds"] == 1.25 and rows["check"]["duration_seconds"] is None
    doc = json.loads(rows["load"]["json"])
    assert list(doc) == sorted(doc)
    assert doc["started_at"] == "2026-04-01T10:00:00.000000+00:00" and doc["error_message"] is None


def test_run_metrics(spark):
    df = steps(
        spark,
        ("r", "b", "failed", T0 + dt.timedelta(seconds=2), T0 + dt.timedelta(seconds=5), None, "no"),
        ("r", "a", "success", T0, T0 + dt.timedelta(seconds=1), 4, None),
    )
    row = m.run_metrics(df, "name").first()
    doc = json.loads(m.run_json(m.run_metrics(df, "name")).first()["json"])
    assert list(doc) == sorted(doc) and list(doc["steps"][0]) == sorted(doc["steps"][0])
    assert (doc["pipeline_name"], doc["duration_seconds"], doc["steps"][1]["duration_seconds"]) == ("name", 5.0, 3.0)
    assert (row["status"], row["duration_seconds"], [s["step_name"] for s in row["steps"]]) == ("failed", 5.0, ["a", "b"])


def report(spark, latest, finished, failed, total, levels=ServiceLevels()):
    facts = spark.createDataFrame(
        [(latest, T0, T0 - dt.timedelta(minutes=5), finished, failed, total)],
        "latest_data_at timestamp, checked_at timestamp, pipeline_started_at timestamp, "
        "pipeline_finished_at timestamp, failed_runs bigint, total_runs bigint",
    )
    return m.sla_report(facts, levels).first()


def test_sla_within_limits(spark):
    row = report(spark, T0 - dt.timedelta(minutes=15), T0 - dt.timedelta(minutes=4), 0, 10)
    assert (row["data_freshness_minutes"], row["pipeline_latency_seconds"], row["failure_rate"]) == (15.0, 60.0, 0.0)
    assert row["passed"] and row["violations"] == []


def test_sla_all_broken_in_order_and_missing(spark):
    row = report(spark, T0 - dt.timedelta(days=3), T0 + dt.timedelta(minutes=5), 2, 10)
    assert row["failure_rate"] == 0.2 and not row["passed"]
    assert row["violations"] == ["freshness_sla_breached", "latency_sla_breached", "failure_rate_sla_breached"]
    row = report(spark, None, None, 2, 0)
    assert row["failure_rate"] == 0.0
    assert row["violations"] == ["freshness_missing", "latency_missing"]


def test_limits_themselves_pass(spark):
    row = report(spark, T0 - dt.timedelta(minutes=1440), T0, 5, 100)
    assert row["passed"], row


def test_failure_classes(spark):
    log = spark.createDataFrame([(" Timeout ", 429), ("schema", 404), ("unexpected", 503)], "error_type string, code int")
    rows = m.classify_failures(log, "error_type", "code").collect()
    assert [(r["failure_class"], r["status_retryable"]) for r in rows] == [
        ("retryable", True),
        ("non_retryable", False),
        ("unknown", True),
    ]


def test_run_counts(spark):
    df = steps(spark, *[("r", "a", "failed" if i < 2 else "success", T0, T0, 1, None) for i in range(10)])
    assert tuple(m.run_counts(df).first()) == (2, 10)
    assert tuple(m.run_counts(df, "step_name").first()) == ("a", 2, 10)
