import datetime as dt
from decimal import Decimal

import pytest

from barloom import schemas as S
from barloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        {
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.enabled": "false",
            "spark.default.parallelism": "2",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def utc(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def bar(ts, symbol, open_, high, low, close, volume, source="alpha_vantage"):
    prices = [None if p is None else Decimal(str(p)) for p in (open_, high, low, close)]
    return (utc(ts) if isinstance(ts, str) else ts, symbol, *prices, volume, source)


@pytest.fixture
def bars_of(spark):
    return lambda rows: spark.createDataFrame(rows, S.BARS)


@pytest.fixture
def mart_bars(bars_of):
    return bars_of(
        [
            bar("2026-04-06T10:00", "TESTA", 10, 12, 9, 11, 100),
            bar("2026-04-06T11:00", "TESTA", 11, 13, 10, 12, 200),
            bar("2026-04-06T10:00", "TESTB", 20, 22, 19, 21, 50),
            bar("2026-04-06T11:00", "TESTB", 21, 23, 20, 22, 70),
        ]
    )
