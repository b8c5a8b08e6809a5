import csv
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from barloom.functions.values import object_key, object_uri
from barloom.operators import staging
from barloom.sources import export, payloads as pl
from tests.payload_samples import payload

DAY = dt.date(2026, 6, 20)


def test_landing_keeps_text_and_replaces_on_rerun(spark, tmp_path):
    root = str(tmp_path / "raw")
    text = payload("AAPL", {"2026-06-19": (1, 2, 1, 2, 3)})
    df = spark.createDataFrame([(text, DAY), (payload("msft", {}), DAY)], "value string, run_date date")
    pl.land_payloads(df, root)
    pl.land_payloads(df.limit(1), root)
    assert glob.glob(f"{root}/run_date=2026-06-20/symbol=AAPL/part-*")
    assert glob.glob(f"{root}/run_date=2026-06-20/symbol=msft/part-*"), "other symbols of the date stay"
    back = pl.read_landing(spark, root).where(F.col("run_date") == F.lit(DAY)).collect()
    assert sorted(r["value"].strip() for r in back) == sorted([text, payload("msft", {})])
    assert staging.stage_bars(pl.read_landing(spark, root)).first()["symbol"] == "AAPL"


def test_payload_files_of_many_lines_or_one(spark, tmp_path):
    (tmp_path / "a").mkdir()
    text = payload("A", {"2026-06-19": (1, 2, 1, 2, 3)})
    (tmp_path / "a" / "stock.json").write_text(text)
    assert staging.stage_bars(pl.read_payload_files(spark, str(tmp_path / "a"))).count() == 1
    (tmp_path / "b").mkdir()
    import json

    lines = "\n".join(json.dumps(json.loads(payload(s, {"2026-06-19": (1, 2, 1, 2, 3)}))) for s in "XYZ")
    (tmp_path / "b" / "many.jsonl").write_text(lines)
    assert staging.stage_bars(pl.read_payload_lines(spark, str(tmp_path / "b"))).count() == 3


def test_object_store_landing(spark, tmp_path):
    df = spark.createDataFrame([("{}", " aapl", dt.date(2026, 5, 28))], "value string, symbol string, date date")
    bucket = str(tmp_path)
    assert pl.land_in_object_store(df, None, bucket) is None
    assert pl.land_in_object_store(df, "false", bucket) is None
    with pytest.raises(pl.LandingConfigError, match="bucket must be provided"):
        pl.land_in_object_store(df, "True", "  ")
    pl.land_in_object_store(df, "TRUE", bucket)
    assert glob.glob(f"{bucket}/raw/alpha_vantage/symbol=AAPL/date=2026-05-28/part-*")
    with pytest.raises(Exception, match="symbol and date must be provided"):
        pl.land_in_object_store(df.withColumn("symbol", F.lit(" ")), "true", bucket)


def test_object_keys(spark):
    df = spark.createDataFrame(
        [("alpha_vantage", "aapl ", dt.date(2026, 5, 28), "stock.json"), (" ", "A", dt.date(2026, 5, 28), "f")],
        "source string, symbol string, day date, file string",
    )
    key = object_key(F.col("source"), F.col("symbol"), F.col("day"), F.col("file"))
    rows = df.select(key.alias("k"), object_uri(F.lit("bucket"), key).alias("u")).collect()
    assert rows[0]["k"] == "raw/alpha_vantage/symbol=AAPL/date=2026-05-28/stock.json"
    assert rows[0]["u"] == "s3://bucket/raw/alpha_vantage/symbol=AAPL/date=2026-05-28/stock.json"
    assert rows[1]["k"] is None


def test_csv_snapshot(mart_bars, tmp_path):
    out = str(tmp_path / "snap_1.csv")
    export.export_snapshot(mart_bars, out, "TESTB")
    rows = [row for part in sorted(glob.glob(f"{out}/part-*.csv")) for row in csv.DictReader(open(part))]
    assert [r["event_ts"][:16] for r in rows] == ["2026-04-06T10:00", "2026-04-06T11:00"]
    assert list(rows[0]) == [
        "event_ts", "symbol", "open", "high", "low", "close", "volume", "source", "snapshot_id", "ingested_at",
    ]
    assert rows[0]["snapshot_id"] == "snap_1" and rows[0]["ingested_at"]
    empty = str(tmp_path / "none")
    export.export_snapshot(mart_bars, empty, "NONE")
    parts = glob.glob(f"{empty}/part-*.csv")
    assert parts and all(open(p).read().startswith("event_ts,symbol,open") for p in parts)


def test_export_is_ordered(mart_bars):
    rows = [(r["symbol"], r["ts"]) for r in export.export_bars(mart_bars.repartition(3)).collect()]
    assert rows == sorted(rows)


def test_two_payloads_of_one_symbol_and_run_date_fail(spark, tmp_path):
    import datetime as dt

    from barloom.sources.payloads import LandingConfigError, land_payloads
    from tests.payload_samples import payload

    text = payload("A", {"2026-04-01": (1, 1, 1, 1, 1)})
    twice = spark.createDataFrame([(text, dt.date(2026, 4, 2))] * 2, "value string, run_date date")
    try:
        land_payloads(twice, str(tmp_path / "raw"))
        raise AssertionError("landed")
    except LandingConfigError as error:
        assert "2 payloads for run_date=2026-04-02, symbol=A" in str(error)
    assert not (tmp_path / "raw").exists()
