"""Expressions that judge runs: error classes, rates and service levels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions.values import strip


@dataclass(frozen=True)
class ServiceLevels:
    max_freshness_minutes: float = S.MAX_FRESHNESS_MINUTES
    max_latency_seconds: float = S.MAX_LATENCY_SECONDS
    max_failure_rate: float = S.MAX_FAILURE_RATE


def failure_class(error_type: Column) -> Column:
    name = F.lower(strip(error_type))
    return (
        F.when(name.isin(*S.RETRYABLE_ERRORS), "retryable")
        .when(name.isin(*S.NON_RETRYABLE_ERRORS), "non_retryable")
        .otherwise("unknown")
    )


def is_retryable_status(code: Column) -> Column:
    return code.isin(*S.RETRYABLE_STATUS_CODES)


def failure_rate(failed: Column, total: Column) -> Column:
    return F.when(total <= 0, F.lit(0.0)).otherwise(F.round(failed / F.nullif(total, F.lit(0)), 6))


def violations(freshness: Column, latency: Column, rate: Column, levels: ServiceLevels) -> Column:
    """Codes of the broken service levels: freshness, then latency, then failure rate."""
    found = F.array(
        F.when(freshness.isNull(), "freshness_missing").when(
            freshness > levels.max_freshness_minutes, "freshness_sla_breached"
        ),
        F.when(latency.isNull(), "latency_missing").when(
            latency > levels.max_latency_seconds, "latency_sla_breached"
        ),
        F.when(rate > levels.max_failure_rate, "failure_rate_sla_breached"),
    )
    return F.array_compact(found)
