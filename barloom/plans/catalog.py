"""Every operator as a query over the driver's tables: name -> (spark, sf_dir) -> DataFrame.

State-dependent operators split the derived bars at fixed times into what a table
already holds and what a load delivers. Results are whole; only top-k reports limit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import schemas as S
from barloom.functions.outcomes import failure_rate
from barloom.functions.times import utc_date
from barloom.functions.values import first_present, object_key
from barloom.operators import backfill, incremental, marts, metrics, quality, reports, staging, upsert
from barloom.plans import load, publish, serve
from barloom import session
from barloom.session import use_utc, work_folder
from barloom.sources import export, footers, payloads, tables as tb, testdata as td
from barloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = dt.datetime(2024, 2, 1, 12, 0, 0)
CHECKED_AT = dt.datetime(2024, 1, 31, 12, 0, 0)
AS_OF = dt.date(2024, 2, 5)
CREATED_AT = dt.datetime(2020, 1, 1, 0, 0, 0)
LOAD_DATE = dt.date(2024, 2, 1)
BACKFILL_START = dt.date(1999, 6, 1)
BACKFILL_END = dt.date(2000, 3, 31)
INTERRUPTED_AT = dt.date(1999, 9, 1)
FIRST_DELIVERY_UNTIL = dt.date(2024, 1, 20)
DELETED_DAY = dt.date(2024, 1, 10)


def _comparable(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC times and exact decimals as doubles, as the SQL side returns them."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        out.append(column.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(fn(use_utc(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


# --- inputs ------------------------------------------------------------------


def _by_source(shipments: str, others: str):
    return F.when(F.col("source") == td.SHIPMENT_SOURCE, F.lit(shipments)).otherwise(F.lit(others)).cast("timestamp")


def _existing(bars: DataFrame) -> DataFrame:
    """Stored bars: up to a time per source, without the 13th of each month, and all of one symbol."""
    stored = (F.col("ts") < _by_source("2000-01-01", "2024-01-20")) & (F.dayofmonth("ts") != 13)
    return bars.where(stored | (F.col("symbol") == "ERROR"))


def _delivered(bars: DataFrame) -> DataFrame:
    """A delivery of what is not stored, and of some that is; one symbol is not in it."""
    later = F.col("ts") >= _by_source("1999-07-01", "2024-01-10")
    return bars.where((later | (F.dayofmonth("ts") == 13)) & (F.col("symbol") != "ERROR"))


def _state(bars: DataFrame) -> DataFrame:
    marks = incremental.batch_marks(_existing(bars))
    return marks.select(
        *S.LOAD_STATE_KEY,
        F.col("max_ts").alias("last_watermark"),
        F.col("row_count").alias("last_row_count"),
        F.lit("seeded").alias("status"),
        F.lit(CREATED_AT).cast("timestamp").alias("updated_at"),
    )


def _daily(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol", "source", utc_date("ts").alias("day")).agg(
        F.min_by("open", "ts").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "ts").alias("close"),
        F.sum("volume").alias("volume"),
    )


def _payload_text(days: DataFrame, close, zone, without=lambda name: F.lit(False)) -> DataFrame:
    """Raw payload text, one per symbol and calendar month (at most 31 entries each), without the fields that ``without`` names."""
    text = {name: F.col(name).cast("string") for name in (*S.PRICE_COLUMNS, "volume")}
    fields = F.create_map(
        F.lit(S.SERIES_OPEN), text["open"],
        F.lit(S.SERIES_HIGH), text["high"],
        F.lit(S.SERIES_LOW), text["low"],
        F.lit(S.SERIES_CLOSE), close,
        F.lit(S.SERIES_VOLUME), text["volume"],
    )
    fields = F.map_filter(fields, lambda name, _: ~without(name))
    entry = F.struct(F.date_format("day", "yyyy-MM-dd").alias("d"), fields.alias("f"))
    months = days.groupBy("symbol", zone.alias("zone"), F.trunc("day", "month").alias("month")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("series")
    )
    padded = F.concat(F.lit(" "), F.lower("symbol"), F.lit(" "))
    meta = F.create_map(F.lit(S.META_SYMBOL), padded, F.lit(S.META_ZONE), F.col("zone"))
    document = F.concat(
        F.lit('{"%s": ' % S.META_FIELD), F.to_json(meta), F.lit(', "%s": ' % S.SERIES_FIELD), F.to_json("series"), F.lit("}")
    )
    return months.select(document.alias("value"))


def _payloads(bars: DataFrame) -> DataFrame:
    """All bars as payloads; a close price whose day's volume is a multiple of 97 is unreadable."""
    close = F.when(F.col("volume") % 97 == 0, F.lit("n/a")).otherwise(F.col("close").cast("string"))
    zone = F.when(F.col("source") == td.SHIPMENT_SOURCE, F.lit(S.DEFAULT_ZONE)).otherwise(F.lit("UTC"))
    return _payload_text(_daily(bars), close, zone)


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of the users' daily bars: the first part of the month, then all of it with closes corrected."""
    days = td.user_bars(spark, sf_dir).withColumn("day", utc_date("ts"))
    early = days.where(F.col("day") <= F.lit(FIRST_DELIVERY_UNTIL))
    corrected = (F.col("close") + 1).cast(S.PRICE).cast("string")
    return (
        _payload_text(early, F.col("close").cast("string"), F.lit("UTC")),
        _payload_text(days, corrected, F.lit("UTC")),
    )


def _step_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a run log: an error is a failed step, a signup a step still running."""
    events = td.instants(td.table(spark, sf_dir, "events"), "ts")
    lasted = F.expr("make_dt_interval(0, 0, 0, cast(value as decimal(18, 6)))")
    failed = F.col("event_type") == "error"
    return events.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.col("event_type").alias("step_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("ts").alias("started_at"),
        F.when(F.col("event_type") != "signup", F.col("ts") + lasted).alias("finished_at"),
        F.get_json_object("props", "$.k").cast("bigint").alias("row_count"),
        F.when(failed, F.concat(F.lit("user "), F.col("user_id").cast("string"))).alias("error_message"),
        "user_id",
    )


# --- staging and raw files ---------------------------------------------------


@query
def stage_bars(spark, sf_dir):
    return staging.stage_bars(_payloads(td.bars(spark, sf_dir)))


@query
def stage_bars_as_delivered(spark, sf_dir):
    """The older form of staging: symbols as delivered, no source."""
    parsed = staging.parse_payloads(_payloads(td.bars(spark, sf_dir)), normalize=False)
    return staging.accepted(parsed).select(*staging.BAR_COLUMNS)


@query
def bars_without_source(spark, sf_dir):
    return staging.with_source(td.user_bars(spark, sf_dir).drop("source"))


@query
def staging_rejects(spark, sf_dir):
    parsed = staging.parse_payloads(_payloads(td.bars(spark, sf_dir)))
    return staging.rejected(parsed).select("symbol", "raw_date", "zone", staging.REASON)


@query
def schema_gaps(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    volume = F.col("volume")
    pairs = {name: F.col(name).cast("string") for name in S.REQUIRED_BAR_FIELDS}
    full = F.create_map(*[part for name, value in pairs.items() for part in (F.lit(name), value)])
    record = F.map_filter(
        full,
        lambda k, v: ~(
            ((k == "volume") & (volume % 7 == 0)) | ((k == "open") & (volume % 11 == 0)) | ((k == "ts") & (volume % 13 == 0))
        ),
    )
    gaps = staging.schema_gaps(bars.withColumn("record", record), "record", "symbol", "ts")
    return gaps.withColumn("missing", F.array_join("missing", ", "))


@query
def payload_gaps(spark, sf_dir):
    """Entries of raw payloads that came without their open price or their volume."""
    volume = F.col("volume")
    lost = lambda name: ((name == S.SERIES_OPEN) & (volume % 11 == 0)) | ((name == S.SERIES_VOLUME) & (volume % 7 == 0))
    payload = _payload_text(_daily(td.bars(spark, sf_dir)), F.col("close").cast("string"), F.lit("UTC"), lost)
    return staging.payload_gaps(payload).withColumn("missing", F.array_join("missing", ", "))


@query
def raw_object_keys(spark, sf_dir):
    days = _daily(td.bars(spark, sf_dir))
    filename = F.when(F.col("volume") % 50 == 0, F.lit("  ")).otherwise(F.lit("stock.json"))
    padded = F.concat(F.lit(" "), F.lower("symbol"))
    return days.select(object_key(F.col("source"), padded, F.col("day"), filename).alias("object_key")).where(
        "object_key IS NOT NULL"
    )


@query
def export_bars(spark, sf_dir):
    return export.snapshot_rows(td.bars(spark, sf_dir), "market_bars").drop("ingested_at")


@query
def export_symbol(spark, sf_dir):
    return export.export_bars(td.bars(spark, sf_dir), "PURCHASE")


@query
def snapshot_stamp(spark, sf_dir):
    """Exported rows are stamped with the time of the export."""
    began = F.lit(dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=1))
    rows = export.snapshot_rows(td.user_bars(spark, sf_dir), "user_bars")
    in_time = F.col("ingested_at").between(began, F.current_timestamp())
    return rows.select("symbol", "event_ts", "snapshot_id", in_time.alias("stamped"))


def _landed(rows: DataFrame) -> DataFrame:
    return staging.accepted(staging.parse_payloads(rows))


@query
def land_payloads(spark, sf_dir):
    """Two run dates of every user's payloads, landed, the first one twice, and read back."""
    root = work_folder(spark, "land_payloads")
    first, second = (
        delivery.withColumn("run_date", F.lit(day))
        for day, delivery in zip((FIRST_DELIVERY_UNTIL, LOAD_DATE), _deliveries(spark, sf_dir))
    )
    for rows in (first.unionByName(second), first):
        payloads.land_payloads(rows, root)
    return _landed(payloads.read_landing(spark, root)).select("run_date", *staging.BAR_COLUMNS)


@query
def land_objects(spark, sf_dir):
    """Every user's payload in the object-store layout, with the bars each object holds."""
    folder = work_folder(spark, "land_objects")
    delivery = _deliveries(spark, sf_dir)[1]
    rows = delivery.select("value", payloads.payload_symbol().alias("symbol"), F.lit(LOAD_DATE).alias("date"))
    payloads.land_in_object_store(rows, "true", folder)
    found = _landed(payloads.read_payload_files(spark, folder))
    key = F.regexp_extract(F.col("file"), "(raw/.*)/[^/]*$", 1).alias("object_prefix")
    return found.groupBy(key, "symbol").agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"))


# --- keyed writes ------------------------------------------------------------


@query
def upsert_bars(spark, sf_dir):
    stored = td.shipment_bars(spark, sf_dir).where(F.col("ts") < F.lit("1999-01-01").cast("timestamp"))
    delivered = td.shipment_rows(spark, sf_dir).where(F.col("ts") >= F.lit("1998-07-01").cast("timestamp"))
    last = upsert.last_per_key(delivered, S.BAR_KEY, ["l_orderkey", "l_linenumber", "close", "volume"])
    return upsert.upsert(stored, staging.with_source(last.drop("l_orderkey", "l_linenumber")), S.BAR_KEY)


@query
def insert_if_absent(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    corrected = _delivered(bars).withColumn("close", (F.col("close") + 1).cast(S.PRICE))
    return upsert.insert_if_absent(_existing(bars), corrected, S.BAR_KEY)


@query
def upsert_daily_summary(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    stored = marts.daily_summary(_existing(bars)).withColumn("created_at", F.lit(CREATED_AT).cast("timestamp"))
    return marts.merge_summary(stored, marts.daily_summary(_delivered(bars)), F.lit(NOW).cast("timestamp"))


@query
def upsert_latest_price(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    stored = marts.latest_price(_existing(bars)).withColumn("updated_at", F.lit(CREATED_AT).cast("timestamp"))
    return marts.advance_latest(stored, marts.latest_price(_delivered(bars)), F.lit(NOW).cast("timestamp"))


@query
def backfill_column_default(spark, sf_dir):
    orders = td.instants(td.table(spark, sf_dir, "orders"), "o_orderdate")
    created = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate"))
    updated = F.when(F.col("o_orderstatus") != "O", F.date_add("o_orderdate", 1).cast("timestamp"))
    rows = orders.select("o_orderkey", created.alias("created_at"), updated.alias("updated_at"))
    return rows.select("o_orderkey", first_present("updated_at", F.col("created_at"), F.lit(NOW).cast("timestamp")))


# --- incremental loads and backfill ------------------------------------------


@query
def incremental_filter(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    return incremental.filter_new(_delivered(bars), _state(bars))


@query
def late_rows(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    late = incremental.late_rows(_delivered(bars), _state(bars), _existing(bars))
    return late.select("source", "symbol", "ts", "close", "volume", "last_watermark")


@query
def advance_watermark(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    state = _state(bars)
    loaded = incremental.filter_new(_delivered(bars), state)
    return incremental.advance_marks(state, loaded, F.lit(NOW).cast("timestamp"))


@query
def load_state_listing(spark, sf_dir):
    return reports.load_state_listing(_state(td.bars(spark, sf_dir)))


@query
def load_audit(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    loaded = incremental.filter_new(_delivered(bars), _state(bars))
    return incremental.audit_rows(loaded, "load-1", LOAD_DATE)


def _bar_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of all bars, derived once: plans read them several times, as they would a stored table."""
    return session.written(td.bars(spark, sf_dir).select("source", "symbol", "ts"), "bar-keys")


def _subjects(bars: DataFrame) -> DataFrame:
    return bars.select(*S.LOAD_STATE_KEY).distinct()


def _recorded_progress(bars: DataFrame) -> DataFrame:
    """Progress written by an earlier run that stopped at the end of August."""
    dated = _delivered(bars).select(*S.LOAD_STATE_KEY, utc_date("ts").alias("trading_date")).distinct()
    return dated.where(F.col("trading_date") < F.lit(INTERRUPTED_AT))


def _gaps(bars: DataFrame) -> DataFrame:
    done = backfill.completed_dates(_recorded_progress(bars), _existing(bars), BACKFILL_START, BACKFILL_END)
    return backfill.pending_intervals(_subjects(bars), backfill.day_intervals(done), BACKFILL_START, BACKFILL_END)


def _pending(bars: DataFrame) -> DataFrame:
    return backfill.days_of(_gaps(bars))


@query
def backfill_gaps(spark, sf_dir):
    return _gaps(_bar_keys(spark, sf_dir))


@query
def progress_intervals(spark, sf_dir):
    return backfill.day_intervals(_recorded_progress(td.bars(spark, sf_dir)))


@query
def backfill_plan(spark, sf_dir):
    return _pending(_bar_keys(spark, sf_dir))


@query
def backfill_rows(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    return backfill.rows_in_intervals(_delivered(bars), _gaps(bars), F.lit("UTC"))


@query
def backfill_rows_zoned(spark, sf_dir):
    """Days of a zone five hours behind UTC."""
    bars = td.bars(spark, sf_dir)
    return backfill.rows_for_dates(_delivered(bars), _pending(bars), F.lit("Etc/GMT+5"))


@query
def backfill_progress(spark, sf_dir):
    bars = _bar_keys(spark, sf_dir)
    done = backfill.completed_dates(_recorded_progress(bars), _existing(bars), BACKFILL_START, BACKFILL_END)
    finished = backfill.finished_dates(_pending(bars), _delivered(bars))
    return done.unionByName(finished).distinct()


@query
def backfill_watermark(spark, sf_dir):
    bars = td.bars(spark, sf_dir)
    rows = backfill.rows_for_dates(_delivered(bars), _pending(bars), F.lit("UTC"))
    return incremental.advance_marks(_state(bars), rows, F.lit(NOW).cast("timestamp"))


# --- marts and reports -------------------------------------------------------


@query
def mart_daily_summary(spark, sf_dir):
    return marts.fit_symbol(marts.daily_summary(td.bars(spark, sf_dir)))


@query
def mart_latest_price(spark, sf_dir):
    return marts.latest_price(td.bars(spark, sf_dir))


@query
def mart_volume_rank(spark, sf_dir):
    return marts.volume_rank(marts.daily_summary(td.bars(spark, sf_dir)))


@query
def bars_row_number(spark, sf_dir):
    return reports.bar_row_numbers(session.written(td.bars(spark, sf_dir), "bars"))


@query
def price_changes(spark, sf_dir):
    return reports.price_changes(session.written(td.bars(spark, sf_dir), "bars"))


@query
def recent_price_changes(spark, sf_dir):
    return reports.chart_order(reports.recent_price_changes(td.bars(spark, sf_dir), "S7", 30))


@query
def volume_leaders(spark, sf_dir):
    return reports.volume_leaders(marts.volume_rank(marts.daily_summary(td.bars(spark, sf_dir))))


@query
def latest_price_listing(spark, sf_dir):
    return reports.latest_price_listing(marts.latest_price(td.bars(spark, sf_dir)))


@query
def recent_latest_prices(spark, sf_dir):
    return reports.recent_latest_prices(marts.latest_price(td.bars(spark, sf_dir)))


@query
def daily_close_range(spark, sf_dir):
    return reports.daily_close_range(marts.daily_summary(td.bars(spark, sf_dir)))


@query
def symbol_coverage(spark, sf_dir):
    return reports.symbol_coverage(td.bars(spark, sf_dir))


@query
def serve_latest_price(spark, sf_dir):
    return reports.serve_latest(marts.latest_price(td.bars(spark, sf_dir)))


@query
def recent_loads(spark, sf_dir):
    days = td.bars(spark, sf_dir).groupBy(*S.LOAD_STATE_KEY, utc_date("ts").alias("load_date")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    audit = days.select(
        F.md5(F.concat_ws("|", F.date_format("load_date", "yyyy-MM-dd"), "source", "symbol")).alias("id"),
        "source",
        "load_date",
        F.date_format("load_date", "yyyy-MM-dd").alias("version"),
        "record_count",
        F.col("load_date").cast("timestamp").alias("recorded_at"),
    )
    return reports.recent_loads(audit)


# --- quality -----------------------------------------------------------------


@query
def quality_checks(spark, sf_dir):
    return quality.bar_audit(td.bars(spark, sf_dir))


@query
def quality_gate(spark, sf_dir):
    return quality.bar_gate(td.bars(spark, sf_dir), as_of=AS_OF)


@query
def gate_failures(spark, sf_dir):
    return quality.failure_message(quality.bar_gate(td.shipment_rows(spark, sf_dir), as_of=AS_OF))


@query
def gate_raises(spark, sf_dir):
    """What the gate raises for rows that fail it, and the number of checks where none fails."""
    outcomes = []
    for name, rows in (("bars", td.bars(spark, sf_dir)), ("shipments", td.shipment_rows(spark, sf_dir))):
        report = quality.bar_gate(rows, as_of=AS_OF).collect()
        try:
            outcomes.append((name, quality.require_passed(report), None))
        except quality.QualityGateError as error:
            outcomes.append((name, None, str(error)))
    return spark.createDataFrame(outcomes, "checked string, checks int, message string")


@query
def dq_not_null(spark, sf_dir):
    labels = td.table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = td.table(spark, sf_dir, "documents").select("doc_id")
    return quality.check_not_null(documents.join(labels, "doc_id", "left"), "documents", "quality")


@query
def dq_unique(spark, sf_dir):
    return quality.check_unique(td.shipment_rows(spark, sf_dir), "shipments", ["symbol", "ts"])


@query
def dq_range(spark, sf_dir):
    return quality.check_range(td.bars(spark, sf_dir), "market_bars", "close", min_value=10, max_value=60000)


@query
def dq_foreign_key(spark, sf_dir):
    """Orders whose key is a multiple of 97 name a customer that is not there."""
    customers = td.table(spark, sf_dir, "customer")
    shifted = F.when(F.col("o_orderkey") % 97 == 0, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))
    orders = td.table(spark, sf_dir, "orders").withColumn("o_custkey", shifted)
    return quality.check_foreign_key(orders, "orders", "o_custkey", customers, "customer", "c_custkey")


@query
def dq_freshness(spark, sf_dir):
    events = quality.check_freshness(td.event_bars(spark, sf_dir), "events", "ts", 14, AS_OF)
    orders = td.instants(td.table(spark, sf_dir, "orders"), "o_orderdate")
    return events.unionByName(quality.check_freshness(orders, "orders", "o_orderdate", 14, AS_OF))


# --- run metrics -------------------------------------------------------------


@query
def step_metrics(spark, sf_dir):
    return metrics.step_metrics(_step_runs(spark, sf_dir).drop("user_id"))


@query
def step_json(spark, sf_dir):
    return metrics.step_json(_step_runs(spark, sf_dir)).select("run_id", "json")


@query
def sla_report(spark, sf_dir):
    steps = _step_runs(spark, sf_dir)
    running = F.count_if((F.col("step_name") == "signup") & (F.col("row_count") > 95)) > 0
    facts = steps.groupBy("user_id").agg(
        F.max(F.when(F.col("step_name") == "purchase", F.col("started_at"))).alias("latest_data_at"),
        F.min("started_at").alias("pipeline_started_at"),
        F.when(~running, F.max("finished_at")).alias("pipeline_finished_at"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.count(F.lit(1)).alias("total_runs"),
    )
    report = metrics.sla_report(facts.withColumn("checked_at", F.lit(CHECKED_AT).cast("timestamp")))
    return report.withColumn("violations", F.array_join("violations", ","))


@query
def sla_json(spark, sf_dir):
    steps = _step_runs(spark, sf_dir)
    facts = steps.groupBy("user_id").agg(
        F.max("started_at").alias("latest_data_at"),
        F.min("started_at").alias("pipeline_started_at"),
        F.max("finished_at").alias("pipeline_finished_at"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.count(F.lit(1)).alias("total_runs"),
    )
    report = metrics.sla_report(facts.withColumn("checked_at", F.lit(CHECKED_AT).cast("timestamp")))
    return metrics.sla_json(report).select("user_id", "json")


@query
def failure_rates(spark, sf_dir):
    counts = metrics.run_counts(_step_runs(spark, sf_dir), "user_id")
    return counts.withColumn("failure_rate", failure_rate(F.col("failed_runs"), F.col("total_runs")))


@query
def classify_failures(spark, sf_dir):
    names = (*S.RETRYABLE_ERRORS, *S.NON_RETRYABLE_ERRORS, "unexpected")
    codes = (200, 404, *S.RETRYABLE_STATUS_CODES)
    pick = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % len(names) + 1).cast("int"))
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("user_id") % len(codes) + 1).cast("int"))
    log = td.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit(" "), F.upper(pick), F.lit(" ")).alias("error_type"), code.alias("status_code")
    )
    return metrics.classify_failures(log, "error_type", "status_code")


# --- whole jobs: tables are written to the session's shared work folder ------


@query
def incremental_load_job(spark, sf_dir):
    root = work_folder(spark, "incremental_load_job")
    for delivery in _deliveries(spark, sf_dir):
        load.load_incremental(spark, root, delivery, now=NOW)
    return tb.read_table(spark, root, tb.BARS)


@query
def backfill_job(spark, sf_dir):
    root = work_folder(spark, "backfill_job")
    first, corrected = _deliveries(spark, sf_dir)
    load.load_incremental(spark, root, first, now=NOW)
    load.backfill(spark, root, corrected, dt.date(2024, 1, 15), dt.date(2024, 1, 25), now=NOW)
    return tb.read_table(spark, root, tb.PROGRESS)


@query
def mart_refresh_job(spark, sf_dir):
    root = work_folder(spark, "mart_refresh_job")
    for delivery in _deliveries(spark, sf_dir):
        load.load_incremental(spark, root, delivery, now=NOW)
        publish.refresh_marts(spark, root, now=NOW)
    summary = tb.read_table(spark, root, tb.DAILY_SUMMARY).drop("created_at")
    ranks = tb.read_table(spark, root, tb.VOLUME_RANK).drop("total_volume")
    return summary.join(ranks, list(S.SUMMARY_KEY))


def _loaded_twice(spark, sf_dir, name):
    root = work_folder(spark, name)
    for delivery in _deliveries(spark, sf_dir):
        load.load_incremental(spark, root, delivery, now=NOW)
    return root


@query
def load_state_job(spark, sf_dir):
    return serve.load_state(spark, _loaded_twice(spark, sf_dir, "load_state_job"))


@query
def load_audit_job(spark, sf_dir):
    """Audit rows of both loads; their ids are of the batch."""
    return tb.read_table(spark, _loaded_twice(spark, sf_dir, "load_audit_job"), tb.LOAD_AUDIT).drop("id")


@query
def latest_price_job(spark, sf_dir):
    root = work_folder(spark, "latest_price_job")
    for delivery in _deliveries(spark, sf_dir):
        load.load_incremental(spark, root, delivery, now=NOW)
        publish.refresh_marts(spark, root, now=NOW)
    return serve.latest_price_listing(spark, root)


@query
def coverage_job(spark, sf_dir):
    """Coverage after two loads of which the marts have seen the first."""
    root = work_folder(spark, "coverage_job")
    first, corrected = _deliveries(spark, sf_dir)
    load.load_incremental(spark, root, first, now=NOW)
    publish.refresh_marts(spark, root, now=NOW)
    load.load_incremental(spark, root, corrected, now=NOW)
    return serve.symbol_coverage(spark, root)


@query
def backfill_bars_job(spark, sf_dir):
    """Bars of the range are corrected where no day was done, others stay as first loaded."""
    root = work_folder(spark, "backfill_bars_job")
    first, corrected = _deliveries(spark, sf_dir)
    load.load_incremental(spark, root, first, now=NOW)
    load.backfill(spark, root, corrected, dt.date(2024, 1, 15), dt.date(2024, 1, 25), now=NOW)
    return tb.read_table(spark, root, tb.BARS)


@query
def interrupted_load_job(spark, sf_dir):
    """A load that dies before it finishes shows nothing; done again, it shows all."""
    root = work_folder(spark, "interrupted_load_job")
    first, corrected = _deliveries(spark, sf_dir)
    load.load_incremental(spark, root, first, now=NOW)
    died = staging.stage_bars(corrected).withColumn("close", (F.col("close") + 100).cast(S.PRICE))
    tb.write_rows(died, root, tb.BARS, tb.new_batch())
    before = tb.read_table(spark, root, tb.BARS).withColumn("phase", F.lit("died"))
    before = session.written(before, "before")
    load.load_incremental(spark, root, corrected, now=NOW)
    return before.unionByName(tb.read_table(spark, root, tb.BARS).withColumn("phase", F.lit("done again")))


@query
def gated_run_job(spark, sf_dir):
    """Steps of two gated runs: one of all deliveries, then one at a later day, when no bar is fresh any more."""
    root = work_folder(spark, "gated_run_job")
    corrected = _deliveries(spark, sf_dir)[1]
    runs = [publish.run_gated(spark, root, corrected, as_of=day) for day in (AS_OF, AS_OF + dt.timedelta(days=365))]
    steps = tb.read_table(spark, root, tb.STEP_RUNS)
    run = F.when(F.col("run_id") == runs[0].run_id, 1).otherwise(2).alias("run")
    return steps.select(run, "step_name", "status", "row_count", "error_message")


@query
def delete_bars(spark, sf_dir):
    """Stored bars without one whole day and without the bars of users on days of an error of theirs."""
    root = work_folder(spark, "delete_bars")
    load.seed_bars(spark, root, td.user_bars(spark, sf_dir))
    tb.delete(spark, root, tb.BARS, utc_date(F.col("ts")) == F.lit(DELETED_DAY))
    failed = td.instants(td.table(spark, sf_dir, "events"), "ts").where("event_type = 'error'")
    symbol = F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")
    tb.delete(spark, root, tb.BARS, keys=failed.select(F.date_trunc("day", "ts").alias("ts"), symbol))
    return tb.read_table(spark, root, tb.BARS)


def _seeded_twice(spark, sf_dir, name):
    """Users' bars, some without an open price or with a negative volume; two seeds share the later days."""
    root = work_folder(spark, name)
    volume = F.col("volume")
    bars = td.user_bars(spark, sf_dir).withColumn("open", F.when(volume % 11 != 0, F.col("open")))
    later = (F.col("ts") > F.lit(FIRST_DELIVERY_UNTIL)) & (volume % 2 == 1)
    for part in (bars.where(~later), bars.where(later)):
        load.seed_bars(spark, root, part.withColumn("volume", F.when(volume % 13 == 0, -volume).otherwise(volume)))
    return root


@query
def day_profile_job(spark, sf_dir):
    return footers.day_profile(spark, _seeded_twice(spark, sf_dir, "day_profile_job"), tb.BARS)


@query
def stored_audit_job(spark, sf_dir):
    return publish.audit_stored(spark, _seeded_twice(spark, sf_dir, "stored_audit_job"))


@query
def stored_freshness_job(spark, sf_dir):
    """Fresh on the gate's day, stale a year later."""
    root = _seeded_twice(spark, sf_dir, "stored_freshness_job")
    days = (AS_OF, AS_OF + dt.timedelta(days=365))
    checks = [publish.check_stored_freshness(spark, root, S.GATE_MAX_AGE_DAYS, day) for day in days]
    return checks[0].unionByName(checks[1])


@query
def stream_load_job(spark, sf_dir):
    """The same two run dates, all files in one batch (0) and two files a batch."""
    out = None
    for files in (None, 2):
        root = work_folder(spark, "stream_load_job")
        for run_date, delivery in zip((FIRST_DELIVERY_UNTIL, LOAD_DATE), _deliveries(spark, sf_dir)):
            delivery.repartition(4, payloads.payload_symbol()).write.text(f"{root}/landing/run_date={run_date}/symbol=many")
            stream = ingest.start_ingest(
                spark, f"{root}/landing", f"{root}/tables", f"{root}/progress", max_files=files, by_line=True
            )
            stream.awaitTermination()
        bars = tb.read_table(spark, f"{root}/tables", tb.BARS).withColumn("files_per_batch", F.lit(files or 0))
        out = bars if out is None else out.unionByName(bars)
    return out
