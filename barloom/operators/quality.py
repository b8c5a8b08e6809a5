"""Data checks. Each returns one row: check_name, table_name, passed, failed_rows, details."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions.times import days_old


class QualityGateError(RuntimeError):
    """The gate found failed checks; the message lists them."""


def _result(counted: DataFrame, check: str, table: str, failed: Column, details: Column) -> DataFrame:
    return counted.select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        (failed == 0).alias("passed"),
        failed.cast("bigint").alias("failed_rows"),
        details.alias("details"),
    )


def out_of_range(column: str, min_value: float | None, max_value: float | None) -> Column:
    """Outside the inclusive bounds; NULL is not outside."""
    if min_value is None and max_value is None:
        raise ValueError("At least one of min_value or max_value must be provided.")
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (F.col(column) < min_value)
    if max_value is not None:
        bad = bad | (F.col(column) > max_value)
    return F.coalesce(bad, F.lit(False))


def check_not_null(df: DataFrame, table: str, column: str) -> DataFrame:
    counted = df.agg(F.count_if(F.col(column).isNull()).alias("n"))
    details = F.format_string(S.NOT_NULL_DETAILS, F.lit(column), F.col("n"))
    return _result(counted, "not_null", table, F.col("n"), details)


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value groups that occur more than once; NULLs group together."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    counted = duplicate_groups(df, columns).agg(F.count(F.lit(1)).alias("n"))
    details = F.format_string(S.UNIQUE_DETAILS, F.lit(", ".join(columns)), F.col("n"))
    return _result(counted, "unique", table, F.col("n"), details)


def check_range(
    df: DataFrame, table: str, column: str, min_value: float | None = None, max_value: float | None = None
) -> DataFrame:
    counted = df.agg(F.count_if(out_of_range(column, min_value, max_value)).alias("n"))
    return _result(counted, "range", table, F.col("n"), _range_details(column, "n", min_value, max_value))


def _range_details(column: str, n: str, min_value: float | None, max_value: float | None) -> Column:
    return F.format_string(S.RANGE_DETAILS, F.lit(column), F.col(n), F.lit(str(min_value)), F.lit(str(max_value)))


def orphan_keys(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with the number of child rows of each.

    Child rows are counted per value before the join, so a value that holds a large
    part of the table crosses the network once per task.
    """
    values = (
        child.where(F.col(child_column).isNotNull())
        .groupBy(F.col(child_column).alias("child_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(F.col(parent_column).alias("parent_value"))
    return values.join(parents, F.col("child_value") == F.col("parent_value"), "left_anti")


def check_foreign_key(
    child: DataFrame,
    child_table: str,
    child_column: str,
    parent: DataFrame,
    parent_table: str,
    parent_column: str,
) -> DataFrame:
    orphans = orphan_keys(child, child_column, parent, parent_column)
    counted = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    details = F.format_string(
        S.FOREIGN_KEY_DETAILS,
        F.lit(child_table),
        F.lit(child_column),
        F.col("n"),
        F.lit(parent_table),
        F.lit(parent_column),
    )
    return _result(counted, "foreign_key", child_table, F.col("n"), details)


def check_freshness(
    df: DataFrame, table: str, ts_column: str, max_age_days: int, as_of: dt.date | None = None
) -> DataFrame:
    counted = df.agg(F.max(ts_column).alias("latest")).select(days_old(F.col("latest"), as_of).alias("age"))
    return _result(counted, "freshness", table, *_freshness(F.col("age"), table, ts_column, max_age_days))


def _freshness(age: Column, table: str, ts_column: str, max_age_days: int) -> tuple[Column, Column]:
    failed = F.when(age <= max_age_days, F.lit(0)).otherwise(F.lit(1))
    details = F.when(age.isNull(), F.lit(S.FRESHNESS_EMPTY_DETAILS % (table, ts_column))).otherwise(
        F.format_string(S.FRESHNESS_DETAILS, F.lit(ts_column), age, F.lit(max_age_days))
    )
    return failed, details


def bar_gate(
    bars: DataFrame, table: str = "market_bars", as_of: dt.date | None = None
) -> DataFrame:
    """The standard checks of the bar table, one row each, numbered by ``seq``.

    Five checks share one aggregate over one scan; only uniqueness needs a shuffle.
    """
    zero = {"min_value": 0, "max_value": None}
    counted = bars.agg(
        F.count_if(F.col("symbol").isNull()).alias("n_symbol"),
        F.count_if(F.col("ts").isNull()).alias("n_ts"),
        F.count_if(out_of_range("close", **zero)).alias("n_close"),
        F.count_if(out_of_range("volume", **zero)).alias("n_volume"),
        days_old(F.max("ts"), as_of).alias("age"),
    )
    stale, stale_details = _freshness(F.col("age"), table, "ts", S.GATE_MAX_AGE_DAYS)

    def entry(seq: int, check: str, failed: Column, details: Column) -> Column:
        return F.struct(
            F.lit(seq).alias("seq"),
            F.lit(check).alias("check_name"),
            F.lit(table).alias("table_name"),
            (failed == 0).alias("passed"),
            failed.cast("bigint").alias("failed_rows"),
            details.alias("details"),
        )

    def null_entry(seq: int, column: str, n: str) -> Column:
        return entry(
            seq, "not_null", F.col(n), F.format_string(S.NOT_NULL_DETAILS, F.lit(column), F.col(n))
        )

    def range_entry(seq: int, column: str, n: str) -> Column:
        return entry(seq, "range", F.col(n), _range_details(column, n, 0, None))

    single_pass = counted.select(
        F.inline(
            F.array(
                null_entry(1, "symbol", "n_symbol"),
                null_entry(2, "ts", "n_ts"),
                range_entry(4, "close", "n_close"),
                range_entry(5, "volume", "n_volume"),
                entry(6, "freshness", stale, stale_details),
            )
        )
    )
    unique = check_unique(bars, table, ["symbol", "ts"]).select(F.lit(3).alias("seq"), *S.CHECK_COLUMNS)
    return single_pass.unionByName(unique)


def bar_audit(bars: DataFrame) -> DataFrame:
    """Eleven counts over the bar table as (seq, metric, value) rows: one plain pass and one group-by."""
    counted = bars.agg(
        F.count(F.lit(1)).alias(AUDIT_COUNTS[0]),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}_count") for c in AUDIT_NULLS],
        negative_prices(),
        negative_volumes(),
    )
    return audit_rows(counted, AUDIT_COUNTS).unionByName(audit_duplicates(bars))


AUDIT_NULLS = ("ts", "symbol", *S.PRICE_COLUMNS, "volume")
AUDIT_COUNTS = ("stock_rows_count", *[f"null_{c}_count" for c in AUDIT_NULLS], "negative_price_count", "negative_volume_count")


def negative_prices() -> Column:
    negative = F.lit(False)
    for name in S.PRICE_COLUMNS:
        negative = negative | F.coalesce(F.col(name) < 0, F.lit(False))
    return F.count_if(negative).alias("negative_price_count")


def negative_volumes() -> Column:
    return F.count_if(out_of_range("volume", 0, None)).alias("negative_volume_count")


def audit_rows(counted: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns of one row as (seq, metric, value) rows."""
    entries = [
        F.struct(F.lit(AUDIT_COUNTS.index(name) + 1).alias("seq"), F.lit(name).alias("metric"), F.col(name).alias("value"))
        for name in names
    ]
    return counted.select(F.inline(F.array(*entries)))


def audit_duplicates(bars: DataFrame) -> DataFrame:
    duplicates = duplicate_groups(bars, ["symbol", "ts"]).agg(F.count(F.lit(1)).alias("value"))
    seq = F.lit(len(AUDIT_COUNTS) + 1).alias("seq")
    return duplicates.select(seq, F.lit("duplicate_stock_key_groups").alias("metric"), "value")


def failure_message(checks: DataFrame) -> DataFrame:
    """One row: the failed checks' details joined in check order, and whether all passed.

    The input is a check report, which has one row per check.
    """
    text = F.concat(F.col("check_name"), F.lit(" on "), F.col("table_name"), F.lit(": "), F.col("details"))
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.struct("seq", text.alias("text")))))
    return checks.agg(failed.alias("failed")).select(
        (F.size("failed") == 0).alias("passed"),
        F.size("failed").alias("failed_checks"),
        F.array_join(F.transform("failed", lambda f: f.getField("text")), "; ").alias("message"),
    )


def require_passed(checks: Sequence[Row]) -> int:
    """Raise when a check of a report failed; otherwise the number of checks."""
    failed = [r for r in sorted(checks, key=lambda r: r["seq"]) if not r["passed"]]
    if failed:
        raise QualityGateError(
            "; ".join(f"{r['check_name']} on {r['table_name']}: {r['details']}" for r in failed)
        )
    return len(checks)
