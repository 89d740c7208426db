from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from wattspan.functions import calendar as cal
from wattspan.functions import comfort, energy


@pytest.fixture
def times(spark):
    def make(*texts):
        return spark.createDataFrame([(at(t) if t else None,) for t in texts], "ts timestamp_ntz")

    return make


def test_band_edges(times):
    df = times("2024-03-08 08:59:59", "2024-03-08 09:00:00", "2024-03-08 18:59:59",
               "2024-03-08 19:00:00", None)
    assert [r[0] for r in df.select(cal.time_band("ts")).collect()] == [1, 2, 2, 3, None]


def test_two_day_of_week_codes(times):
    df = times("2024-03-10 12:00:00", "2024-03-08 12:00:00")
    got = [tuple(r) for r in df.select(cal.dow_sun0("ts"), cal.dow_mon0("ts")).collect()]
    assert got == [(0, 6), (5, 4)]


def test_hour_inside_a_clock_change_is_kept(times):
    row = times("2024-03-31 02:30:00").select(cal.truncate("ts", "hour").alias("h")).first()
    assert row["h"] == datetime(2024, 3, 31, 2)


def test_floor_minutes(times):
    got = times("2024-01-01 10:44:59").select(
        cal.floor_minutes("ts", 15).alias("q"), cal.floor_minutes("ts", 5).alias("f")
    ).first()
    assert (got["q"], got["f"]) == (datetime(2024, 1, 1, 10, 30), datetime(2024, 1, 1, 10, 40))


def test_texts_and_parts(times):
    row = times("2024-03-08 07:05:00").select(
        cal.month_text("ts").alias("m"), cal.date_text("ts").alias("d"),
        *[c.alias(n) for n, c in cal.calendar_parts("ts").items()],
    ).first()
    assert (row["m"], row["d"]) == ("2024-03", "2024-3-8")
    assert (row["year"], row["month"], row["day"], row["hour"], row["dow"]) == (2024, 3, 8, 7, 4)


def test_parse_and_epoch(spark):
    row = spark.sql("SELECT '2024-03-31 02:30:00' AS t, 1711852200L AS s").select(
        cal.parse_text("t").alias("p"), cal.from_epoch("s").alias("e")
    ).first()
    assert row["p"] == row["e"] == datetime(2024, 3, 31, 2, 30)


def test_bucket_columns_of_band(times):
    df = times("2024-03-08 20:00:00")
    cols = cal.bucket_columns("ts", "band")
    assert tuple(df.select(*cols.values()).first()) == (date(2024, 3, 8), 3)
    with pytest.raises(ValueError):
        cal.bucket_columns("ts", "week")


@pytest.mark.parametrize("ok,ko,text", [(2, 1, "66.67%"), (1, 0, "100.00%"), (0, 1, "0.00%")])
def test_percent_text(spark, ok, ko, text):
    got = spark.range(1).select(energy.percent_text(F.lit(ok), F.lit(ok + ko))).first()[0]
    assert got == text


def test_office_counts_missing_as_zero(spark):
    df = spark.sql("SELECT CAST(10 AS DECIMAL(10,2)) b, CAST(NULL AS DECIMAL(10,2)) d, "
                   "CAST(1.25 AS DECIMAL(10,2)) s")
    assert str(df.select(energy.office("b", "d", "s")).first()[0]) == "11.25"


def published_heat(t, rh):
    """Straight evaluation of the published regression, for a check value."""
    if t < 80 or rh < 40:
        return t
    simple = 0.5 * (t + 61 + (t - 68) * 1.2 + rh * 0.094)
    if (simple + t) / 2 < 80:
        return simple
    full = (-42.379 + 2.04901523 * t + 10.14333127 * rh - 0.22475541 * t * rh
            - 0.00683783 * t**2 - 0.05481717 * rh**2 + 0.00122874 * t**2 * rh
            + 0.00085282 * t * rh**2 - 0.00000199 * t**2 * rh**2)
    if rh > 85 and 80 <= t <= 87:
        full += (rh - 85) / 10 * (87 - t) / 5
    return full


@pytest.mark.parametrize("celsius,rh", [(26, 50), (27, 90), (35, 60), (26.7, 40), (40, 45), (10, 99)])
def test_heat_index(spark, celsius, rh):
    df = spark.createDataFrame([(float(celsius), float(rh), 0.0)],
                               "temperature_2m double, relative_humidity_2m double, wind_speed_10m double")
    got = df.select(comfort.weather_indices()["heat_index"]).first()[0]
    assert got == pytest.approx(published_heat(celsius * 9 / 5 + 32, rh), rel=1e-12)


@pytest.mark.parametrize("celsius,wind,chilled", [(5, 10, True), (5, 1, False), (10.1, 10, False), (10, 10, True)])
def test_wind_chill(spark, celsius, wind, chilled):
    df = spark.createDataFrame([(float(celsius), 50.0, float(wind))],
                               "temperature_2m double, relative_humidity_2m double, wind_speed_10m double")
    got = df.select(comfort.weather_indices()["wind_chill"]).first()[0]
    t, v = celsius * 9 / 5 + 32, wind * 2.237
    want = 35.74 + 0.6215 * t - 35.75 * v**0.16 + 0.4275 * t * v**0.16 if chilled else t
    assert got == pytest.approx(want, rel=1e-12)


def test_cyclical(spark):
    row = spark.sql("SELECT 6 AS hour").select(*comfort.cyclical("hour", 24).values()).first()
    assert row[0] == pytest.approx(1.0) and row[1] == pytest.approx(0.0, abs=1e-12)
