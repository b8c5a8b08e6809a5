"""Raw payload text to typed bars.

Every payload is parsed where it lies, each entry of its date map becomes a row, and
rows that cannot be typed carry a reason instead of being lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions.times import is_zone, midnight_in_zone
from barloom.functions.values import clean_symbol, missing_names, to_price, to_volume

REASON = "reject_reason"
REASONS = (UNREADABLE, NO_SYMBOL, BAD_DATE, BAD_PRICE, BAD_VOLUME) = (
    "unreadable payload",
    "missing symbol",
    "bad date or zone",
    "bad price",
    "bad volume",
)
BAR_COLUMNS = S.BARS.fieldNames()


def _entries(payloads: DataFrame, text: str, normalize: bool) -> DataFrame:
    """One row per dated entry of a payload, with ``_fields`` as delivered; ``_fault`` is what is wrong with the whole payload.

    A text is parsed once, to VARIANT. The parser takes a valid beginning and leaves what follows, so it is given a list of the
    text and the text's hash: only where that hash is found second was the text one whole JSON value.
    """
    carried = [c for c in payloads.columns if c != text]
    mark = F.xxhash64(F.col(text))
    listed = F.concat(F.lit("["), F.col(text), F.lit(","), mark.cast("string"), F.lit("]"))
    parsed = payloads.select(*carried, F.try_parse_json(listed).alias("_listed"), mark.alias("_mark"))
    whole = F.try_variant_get("_listed", "$[1]", "bigint") == F.col("_mark")
    part = lambda name, kind: F.when(whole, F.try_variant_get("_listed", f"$[0]['{name}']", kind))
    documents = parsed.select(
        *carried,
        part(S.META_FIELD, "map<string,string>").alias("_meta"),
        part(S.SERIES_FIELD, "map<string,map<string,string>>").alias("_series"),
    )
    meta, series = F.col("_meta"), F.col("_series")
    raw_symbol = meta.getItem(S.META_SYMBOL)
    zone = F.coalesce(meta.getItem(S.META_ZONE), F.lit(S.DEFAULT_ZONE))
    symbol = clean_symbol(raw_symbol) if normalize else raw_symbol
    fault = F.when(meta.isNull() & series.isNull(), UNREADABLE)
    if normalize:
        fault = fault.when(symbol.isNull(), NO_SYMBOL)

    # Once per payload, before its entries are spread out.
    documents = documents.select(*carried, symbol.alias("symbol"), zone.alias("zone"), fault.alias("_fault"), series.alias("_series"))
    return (
        documents.withColumn("_zone_ok", is_zone(F.col("zone")))
        .select(*carried, "symbol", "zone", "_fault", "_zone_ok", F.explode_outer("_series").alias("raw_date", "_fields"))
        .where(F.col("raw_date").isNotNull() | F.col("_fault").isNotNull())
    )


def parse_payloads(payloads: DataFrame, text: str = "value", normalize: bool = True) -> DataFrame:
    """One row per dated entry: the bar columns, ``zone`` and ``reject_reason``.

    Other columns of ``payloads`` (run date, file) are carried along. A payload without
    a symbol or that is not one whole JSON object gives one rejected row; an empty series gives none.
    Of a date or field that occurs twice the last counts.
    ``normalize=False`` is the older form: the symbol stays as delivered and may be NULL.
    """
    carried = [c for c in payloads.columns if c != text]
    entries = _entries(payloads, text, normalize)
    fields = F.col("_fields")
    typed = entries.select(
        *carried,
        F.when(F.col("_zone_ok"), midnight_in_zone(F.col("raw_date"), F.col("zone"))).alias("ts"),
        "symbol",
        to_price(fields.getItem(S.SERIES_OPEN)).alias("open"),
        to_price(fields.getItem(S.SERIES_HIGH)).alias("high"),
        to_price(fields.getItem(S.SERIES_LOW)).alias("low"),
        to_price(fields.getItem(S.SERIES_CLOSE)).alias("close"),
        to_volume(fields.getItem(S.SERIES_VOLUME)).alias("volume"),
        F.lit(S.DEFAULT_SOURCE if normalize else None).cast("string").alias("source"),
        "zone",
        "raw_date",
        "_fault",
    )
    bad_price = F.lit(False)
    for name in S.PRICE_COLUMNS:
        bad_price = bad_price | F.col(name).isNull()
    reason = (
        F.when(F.col("_fault").isNotNull(), F.col("_fault"))
        .when(F.col("ts").isNull(), BAD_DATE)
        .when(bad_price, BAD_PRICE)
        .when(F.col("volume").isNull(), BAD_VOLUME)
    )
    return typed.withColumn(REASON, reason).drop("_fault")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNull()).drop(REASON, "raw_date")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNotNull())


def stage_bars(payloads: DataFrame, text: str = "value", strict: bool = False) -> DataFrame:
    """Typed bars in table column order.

    Strict staging fails the job at the first entry that cannot be typed.
    """
    parsed = parse_payloads(payloads, text)
    if strict:
        message = F.when(F.col(REASON) == NO_SYMBOL, S.MISSING_SYMBOL_MESSAGE).otherwise(F.col(REASON))
        # In a filter, so that the check stays whichever columns are read.
        fail = F.raise_error(message).cast("boolean")
        parsed = parsed.where(F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(fail))
    return accepted(parsed).select(*BAR_COLUMNS)


def with_source(rows: DataFrame, source: str = S.UNKNOWN_SOURCE) -> DataFrame:
    """Rows with or without ``source`` brought to the full bar layout; other layouts are refused."""
    have = set(rows.columns)
    want = set(BAR_COLUMNS)
    if have not in (want, want - {"source"}):
        raise ValueError(f"expected the bar columns with or without source, got {sorted(have)}")
    if "source" not in have:
        rows = rows.withColumn("source", F.lit(source))
    return rows.select(*BAR_COLUMNS)


def require_columns(rows: DataFrame) -> DataFrame:
    """Refuse a table that lacks required bar columns, naming them in sorted order."""
    lacking = sorted(set(S.REQUIRED_BAR_FIELDS).difference(rows.columns))
    if lacking:
        raise ValueError("Missing required stock fields: " + ", ".join(lacking))
    return rows


def payload_gaps(payloads: DataFrame, text: str = "value") -> DataFrame:
    """The dated entries of raw payloads that lack a field: the carried columns, symbol, raw_date, missing (sorted names).

    A field that is there without a value is not missing. Payloads that cannot be read, or without a symbol, have no entries here.
    """
    carried = [c for c in payloads.columns if c != text]
    entries = _entries(payloads, text, normalize=True)
    present = F.coalesce(F.map_keys("_fields"), F.array().cast("array<string>"))
    # One condition on fault and fields: one on the fault alone would be moved below the parse and parse again.
    lacking = F.when(F.col("_fault").isNull(), missing_names(S.SERIES_FIELDS, present))
    return entries.select(*carried, "symbol", "raw_date", lacking.alias("missing")).where(F.size("missing") > 0)


def schema_gaps(records: DataFrame, record: str, *keys: str) -> DataFrame:
    """For raw string-map records: the required fields each one lacks (only incomplete ones)."""
    lacking = missing_names(S.REQUIRED_BAR_FIELDS, F.map_keys(F.col(record)))
    return records.select(*keys, lacking.alias("missing")).where(F.size("missing") > 0)
