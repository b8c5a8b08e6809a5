import datetime as dt
from decimal import Decimal

import pytest

from barloom import schemas as S
from barloom.operators import staging
from tests.conftest import bar
from tests.payload_samples import payload


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_normalizes_symbol_zone_and_types(spark):
    text = payload(" aapl ", {"2026-05-28": ("198.1000", "201.5000", "197.2500", "200.3000", "1234567")}, "US/Eastern")
    df = staging.stage_bars(texts(spark, text))
    assert df.columns == ["ts", "symbol", "open", "high", "low", "close", "volume", "source"]
    row = df.selectExpr("cast(ts as string) AS t", "*").collect()[0]
    assert row["t"] == "2026-05-28 04:00:00"
    assert (row["symbol"], row["close"], row["volume"], row["source"]) == (
        "AAPL",
        Decimal("200.300000"),
        1234567,
        "alpha_vantage",
    )


def test_winter_day_default_zone_and_short_dates(spark):
    text = payload("A", {"2026-1-5": (1, 1, 1, 1, 1)}, None)
    df = staging.stage_bars(texts(spark, text))
    assert df.selectExpr("cast(ts as string)").first()[0] == "2026-01-05 05:00:00"


def test_rejects_keep_reason_and_good_rows_stay(spark):
    ok = (1, 2, 1, 2, 5)
    docs = [
        payload("A", {"2026-01-05": ok, "2026-01-06": ("x", 1, 1, 1, 1), "never": ok}),
        payload("B", {"2026-01-05": (1, 1, 1, "nan", 1), "2026-01-06": (1, 1, 1, 1, "12.5")}),
        payload(None, {"2026-01-05": ok}),
        payload("  ", {}),
        payload("C", {}),
        payload("D", {"2026-01-05": ok}, "Mars/Base"),
        "not json",
    ]
    parsed = staging.parse_payloads(texts(spark, *docs))
    good = {(r["symbol"]) for r in staging.accepted(parsed).collect()}
    assert good == {"A"}
    reasons = sorted(r[staging.REASON] for r in staging.rejected(parsed).collect())
    assert reasons == sorted(
        [
            "bad price",
            "bad date or zone",
            "bad price",
            "bad volume",
            "missing symbol",
            "missing symbol",
            "bad date or zone",
            "unreadable payload",
        ]
    )


def test_strict_mode_raises(spark):
    with pytest.raises(Exception, match="Missing stock symbol"):
        staging.stage_bars(texts(spark, payload(None, {})), strict=True).collect()
    with pytest.raises(Exception, match="bad price"):
        staging.stage_bars(texts(spark, payload("A", {"2026-01-05": ("x", 1, 1, 1, 1)})), strict=True).collect()
    with pytest.raises(Exception, match="bad price"):
        staging.stage_bars(texts(spark, payload("A", {"2026-01-05": ("x", 1, 1, 1, 1)})), strict=True).select("ts").collect()


def test_older_form_keeps_symbol_as_delivered(spark):
    docs = [payload(" aapl ", {"2026-01-05": (1, 1, 1, 1, 1)}), payload(None, {"2026-01-05": (1, 1, 1, 1, 1)})]
    rows = staging.accepted(staging.parse_payloads(texts(spark, *docs), normalize=False)).collect()
    assert sorted((r["symbol"] or "", r["source"]) for r in rows) == [("", None), (" aapl ", None)]


def test_source_is_added_or_kept_and_other_layouts_refused(spark, bars_of):
    full = bars_of([bar("2026-01-05", "A", 1, 1, 1, 1, 1, "x")])
    assert staging.with_source(full).first()["source"] == "x"
    assert staging.with_source(full.drop("source")).first()["source"] == "unknown"
    assert staging.with_source(full.drop("source"), "y").first()["source"] == "y"
    with pytest.raises(ValueError):
        staging.with_source(full.drop("volume"))


def test_required_columns(bars_of, spark):
    full = bars_of([bar("2026-01-05", "A", 1, 1, 1, 1, 1)])
    assert staging.require_columns(full) is full
    with pytest.raises(ValueError, match="close, high, low, volume"):
        staging.require_columns(full.select("symbol", "ts", "open"))
    records = spark.createDataFrame(
        [("a", {f: "1" for f in S.REQUIRED_BAR_FIELDS}), ("b", {"symbol": "x", "ts": "t", "open": "1"})],
        "id string, record map<string,string>",
    )
    gaps = staging.schema_gaps(records, "record", "id").collect()
    assert [(r["id"], r["missing"]) for r in gaps] == [("b", ["close", "high", "low", "volume"])]


def test_payloads_that_are_not_one_whole_document_are_rejected(spark):
    good = payload("A", {"2026-01-05": (1, 1, 1, 1, 1)})
    tails = [good + " x", good + good, good + "]", good + "," + good, good[:-1], "[" + good + "]", "", None, good + ',"end"] x']
    parsed = staging.parse_payloads(texts(spark, "\n " + good + " \t\n", *tails))
    assert staging.accepted(parsed).count() == 1
    assert [r[staging.REASON] for r in staging.rejected(parsed).collect()] == [staging.UNREADABLE] * len(tails)


def test_a_repeated_name_counts_once_with_its_last_value(spark):
    series = ", ".join('"2026-01-05": {"1. open": "%d", "2. high": 9, "3. low": 1.50, "4. close": "2", "5. volume": "3"}' % i for i in (1, 2))
    text = '{"Meta Data": {"2. Symbol": "A", "2. Symbol": "B"}, "Time Series (Daily)": {%s}}' % series
    rows = staging.stage_bars(texts(spark, text)).collect()
    assert [(r["symbol"], r["open"], r["high"], r["low"]) for r in rows] == [("B", 2, 9, Decimal("1.5"))]


def test_gaps_come_from_the_parse_that_gives_bars_and_rejects(spark):
    text = payload("a", {"2026-01-05": (1, 1, 1, 1, 1), "2026-01-06": (1, 1), "2026-01-07": ()})
    docs = texts(spark, text, payload(None, {"2026-01-05": ()}), "{}", '{"Meta Data": {"2. Symbol": "b"}, "Time Series (Daily)": {"d": null}}')
    gaps = {(r["symbol"], r["raw_date"]): r["missing"] for r in staging.payload_gaps(docs).collect()}
    every = ["1. open", "2. high", "3. low", "4. close", "5. volume"]
    assert gaps == {("A", "2026-01-06"): every[2:], ("A", "2026-01-07"): every, ("B", "d"): every}
    for df in (staging.payload_gaps(docs), staging.parse_payloads(docs)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
