from __future__ import annotations

import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattspan.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def kw(value) -> Decimal | None:
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


FEED_SCHEMA = "feed string, seq bigint, ts timestamp_ntz, kilowatt decimal(18,2)"


@pytest.fixture
def feed_rows(spark):
    """Feed rows from (feed, time text, value) in file order."""

    def make(*rows):
        data = [(f, i, at(t), kw(v)) for i, (f, t, v) in enumerate(rows)]
        return spark.createDataFrame(data, FEED_SCHEMA)

    return make


@pytest.fixture
def reading_rows(spark):
    """Readings from (time text, building, data_center, solar)."""
    from wattspan.functions import calendar as cal

    def make(*rows):
        data = [(at(t), kw(b), kw(d), kw(s), kw(b - d + s)) for t, b, d, s in rows]
        schema = "ts timestamp_ntz, " + ", ".join(
            f"{m} decimal(18,2)" for m in ("building", "data_center", "solar", "office")
        )
        df = spark.createDataFrame(data, schema)
        return df.withColumns({"band": cal.time_band("ts"), "dow": cal.dow_sun0("ts")})

    return make


@pytest.fixture
def band_rows(spark):
    """(day, band) table from (day text, band, office)."""

    def make(*rows):
        data = []
        for day, band, office in rows:
            d = date.fromisoformat(day)
            data.append((d, band, kw(1), kw(1), kw(0), kw(office), d.isoweekday() % 7))
        return spark.createDataFrame(
            data,
            "day date, band int, building decimal(18,2), data_center decimal(18,2), "
            "solar decimal(18,2), office decimal(18,2), dow int",
        )

    return make


@pytest.fixture
def weather_rows(spark):
    """Weather from (time text, value): variable i holds value + i."""
    from wattspan.schema import WEATHER, WEATHER_VARS

    def make(*rows):
        data = [(at(t), *[float(v) + i for i in range(len(WEATHER_VARS))]) for t, v in rows]
        return spark.createDataFrame(data, WEATHER)

    return make
