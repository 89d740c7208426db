from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, kw
from wattspan.operators import buckets, merge, remote, weather
from wattspan.schema import WEATHER_VARS
from wattspan.sources.weather import explode_weather


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_insert_ignore(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 'old'), (2, 'old') AS t(k, v)")
    batch = spark.sql("SELECT * FROM VALUES (2, 'new', 1), (3, 'late', 9), (3, 'early', 4) AS t(k, v, seq)")
    once = merge.insert_ignore(target, batch.drop("seq").where("k < 3"), ["k"])
    assert as_dict(once, "k", "v") == {1: "old", 2: "old"}
    rows = merge.rows_to_insert(target, batch, ["k"], order="seq")
    assert as_dict(rows, "k", "v") == {3: "early"}
    again = merge.insert_ignore(merge.insert_ignore(target, rows.drop("seq"), ["k"]), rows.drop("seq"), ["k"])
    assert again.count() == 3


def test_upsert(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 10, 'a'), (2, 20, 'b') AS t(k, kw, w)")
    source = spark.sql("SELECT * FROM VALUES (2, 'x', 1), (2, 'y', 2), (3, NULL, 1) AS t(k, w, n)")
    out = merge.upsert(target, source, ["k"], ["w"], order="n")
    got = {r["k"]: (r["kw"], r["w"]) for r in out.collect()}
    assert got == {1: (10, "a"), 2: (20, "y"), 3: (None, None)}
    again = merge.upsert(out, source, ["k"], ["w"], order="n")
    assert again.exceptAll(out).isEmpty() and out.exceptAll(again).isEmpty()
    cleared = merge.upsert(target, spark.sql("SELECT 1 AS k, CAST(NULL AS STRING) AS w"), ["k"], ["w"])
    assert as_dict(cleared, "k", "w") == {1: None, 2: "b"}


def test_update_from(spark):
    target = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(k, w)")
    source = spark.sql("SELECT * FROM VALUES (2, 'z'), (9, 'q') AS t(k, w)")
    assert as_dict(merge.update_from(target, source, ["k"], ["w"]), "k", "w") == {1: "a", 2: "z"}
    added = merge.update_from(target.drop("w"), source, ["k"], ["w"])
    assert as_dict(added, "k", "w") == {1: None, 2: "z"}


def test_resample_keeps_empty_bins(weather_rows):
    w = weather_rows(("2024-01-01 22:00:00", 10), ("2024-01-02 01:00:00", 20), ("2024-01-02 01:30:00", 30))
    hours = weather.resample(w, "hour")
    got = as_dict(hours, "ts", "temperature_2m")
    assert got == {datetime(2024, 1, 1, 22): 10, datetime(2024, 1, 1, 23): None,
                   datetime(2024, 1, 2, 0): None, datetime(2024, 1, 2, 1): 25}
    assert as_dict(hours, "ts", "band")[datetime(2024, 1, 1, 22)] == 3
    assert as_dict(weather.resample(w, "day"), "ts", "rain") == {
        datetime(2024, 1, 1): 15, datetime(2024, 1, 2): 30}


@pytest.mark.parametrize("grain,expected", [("day", 368), ("month", 14), ("year", 3), ("hour", 366 * 24 + 2)])
def test_spine_crosses_years(weather_rows, grain, expected):
    w = weather_rows(("2023-12-31 23:00:00", 1), ("2025-01-01 00:00:00", 2))
    out = weather.resample(w, grain)
    assert out.count() == expected == out.select("ts").distinct().count()
    assert out.where("rain IS NOT NULL").count() == 2


def test_spine_by_site(weather_rows):
    w = weather_rows(("2024-01-01 00:00:00", 1), ("2024-01-01 02:00:00", 2)).withColumn("site", F.lit(1))
    w = w.unionByName(weather_rows(("2024-05-01 00:00:00", 1)).withColumn("site", F.lit(2)))
    got = weather.resample(w, "hour", ["site"]).groupBy("site").count()
    assert as_dict(got, "site", "count") == {1: 3, 2: 1}


def test_band_weather(weather_rows):
    w = weather_rows(("2024-01-01 09:00:00", 1), ("2024-01-01 18:00:00", 5), ("2024-01-01 19:00:00", 9))
    last = weather.band_weather(w, "last")
    mean = weather.band_weather(w, "mean")
    assert as_dict(last, "band", "temperature_2m") == {2: 5, 3: 9}
    assert as_dict(mean, "band", "temperature_2m") == {2: 3, 3: 9}
    with pytest.raises(ValueError):
        weather.band_weather(w, "first")


def test_stored_weather_rounds_half_up_and_has_no_nan(spark):
    df = spark.sql("SELECT 1 AS k, 0.125D AS rain, CAST('NaN' AS DOUBLE) AS snowfall, 0.145D AS snow_depth, -0.125D AS is_day")
    row = weather.as_stored(df).first()
    assert (row["rain"], row["snowfall"], row["snow_depth"], row["is_day"]) == (
        Decimal("0.13"), None, Decimal("0.15"), Decimal("-0.13"))


def test_merge_adds_weather_only_keys(reading_rows, weather_rows):
    agg = buckets.delta(reading_rows(("2024-01-01 10:00:00", 1, 1, 0), ("2024-01-01 10:30:00", 4, 2, 0)), "hour")
    w = weather_rows(("2024-01-01 10:00:00", 7), ("2024-01-01 11:00:00", 8))
    out = weather.merge_weather(agg, w, "hour")
    rows = {r["ts"].hour: r for r in out.collect()}
    assert (rows[10]["building"], rows[10]["band"], rows[10]["rain"]) == (kw(3), 2, kw(12))
    assert (rows[11]["building"], rows[11]["dow"], rows[11]["band"]) == (None, None, 2)
    assert dict(out.dtypes)["rain"] == "decimal(18,2)"
    same = weather.merge_weather(out, w, "hour")
    assert same.select(*out.columns).exceptAll(out).isEmpty()


def test_explode_response(spark):
    arrays = ", ".join(f"array({i}D, {i + 1}D) AS {v}" for i, v in enumerate(WEATHER_VARS))
    df = spark.sql(f"SELECT 1704067200L AS start, 1704074400L AS end, 3600L AS step, {arrays}")
    got = sorted((r["ts"], r["temperature_2m"], r["terrestrial_radiation"]) for r in explode_weather(df).collect())
    assert got == [(datetime(2024, 1, 1, 0), 0.0, 22.0), (datetime(2024, 1, 1, 1), 1.0, 23.0)]


def test_windows(weather_rows):
    w = weather_rows(*[(f"2024-01-{d:02d} 23:00:00", d) for d in range(1, 31)])
    ahead = weather.forecast_window(w, F.lit("2024-01-16 15:00:00"))
    assert {r["ts"].day for r in ahead.collect()} == set(range(16, 31))
    past = weather.archive_window(w, F.lit("2024-01-05 07:00:00"), F.lit("2024-01-12 00:00:00"))
    assert {r["ts"].day for r in past.collect()} == set(range(5, 13))


# 2024-01-06/07 is a weekend, 2024-01-01..05 are workdays.
def test_threshold_and_flags(band_rows):
    bands = band_rows(
        ("2024-01-06", 2, -10), ("2024-01-07", 2, 20), ("2024-01-01", 2, 129), ("2024-01-02", 2, 15),
        ("2024-01-03", 2, 0), ("2024-01-01", 1, 900), ("2024-01-04", 2, 72))
    row = remote.remote_threshold(bands).first()
    assert (row["weekend_mean"], row["workday_mean"], row["threshold"]) == (15, 72, 25)
    flags = {(r["day"].day, r["band"]): r["remote_flag"] for r in remote.band_flags(bands).collect()}
    assert flags == {(6, 2): "NA", (7, 2): "NA", (1, 2): "KO", (2, 2): "OK", (1, 1): "NA", (4, 2): "KO"}
    equal = {r["day"].day: r["remote_flag"] for r in remote.band_flags(
        bands, headcount=57, always_present=57).where("band = 2").collect()}
    assert equal[4] == "NA"


def test_no_weekend_means_no_flags(band_rows):
    bands = band_rows(("2024-01-01", 2, 5), ("2024-01-02", 2, 50))
    assert remote.remote_threshold(bands).first()["threshold"] is None
    assert {r["remote_flag"] for r in remote.band_flags(bands).collect()} == {"NA"}


def test_sites_have_their_own_threshold(band_rows):
    low = band_rows(("2024-01-06", 2, 10), ("2024-01-01", 2, 67)).withColumn("site", F.lit(1))
    high = band_rows(("2024-01-06", 2, 1000), ("2024-01-01", 2, 67)).withColumn("site", F.lit(2))
    flags = remote.band_flags(low.unionByName(high), ["site"])
    got = {(r["site"], r["day"].day): r["remote_flag"] for r in flags.collect()}
    assert got == {(1, 6): "NA", (1, 1): "KO", (2, 6): "NA", (2, 1): "OK"}


def test_shares_and_counts(spark):
    days = spark.createDataFrame(
        [(at("2024-01-01 00:00:00"), "OK"), (at("2024-01-02 00:00:00"), "OK"), (at("2024-01-03 00:00:00"), "KO"),
         (at("2024-01-06 00:00:00"), "NA"), (at("2024-02-01 00:00:00"), "KO"), (at("2024-03-02 00:00:00"), "NA")],
        "ts timestamp_ntz, remote_flag string")
    months = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts UNION ALL SELECT TIMESTAMP_NTZ '2024-02-01 00:00:00' "
                       "UNION ALL SELECT TIMESTAMP_NTZ '2024-03-01 00:00:00'")
    out = as_dict(remote.flag_periods(months, days, "month"), "ts", "remote_pct")
    assert list(out.values()) and out == {
        datetime(2024, 1, 1): "66.67%", datetime(2024, 2, 1): "0.00%", datetime(2024, 3, 1): None}
    year = remote.flag_periods(months.limit(1), days, "year").first()
    assert year["remote_pct"] == "50.00%"
    assert as_dict(remote.flag_counts(days), "remote_flag", "days") == {"OK": 2, "KO": 2, "NA": 2}


def test_flags_reach_days_and_bands(band_rows, reading_rows, spark):
    bands = band_rows(("2024-01-06", 2, 10), ("2024-01-01", 2, 67), ("2024-01-01", 1, 3), ("2024-01-02", 2, 0))
    flags = remote.band_flags(bands)
    tagged = {(r["day"], r["band"]): r["remote_flag"] for r in remote.flag_bands(bands, flags).collect()}
    assert tagged[(date(2024, 1, 1), 2)] == "KO" and tagged[(date(2024, 1, 2), 2)] is None
    days = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts UNION ALL SELECT TIMESTAMP_NTZ '2024-01-09 00:00:00'")
    assert as_dict(remote.flag_days(days, flags), "ts", "remote_flag") == {
        datetime(2024, 1, 1): "KO", datetime(2024, 1, 9): None}
