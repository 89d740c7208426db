from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import Window, functions as F

from wattspan.operators import buckets, readings
from wattspan.schema import KW, METERS
from wattspan.sources import ramp


def values(df, *cols):
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


def same_rows(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def gappy(feed_rows):
    return feed_rows(
        ("building", "2024-01-01 00:00:00", 100), ("data_center", "2024-01-01 00:00:00", 30),
        ("solar", "2024-01-01 00:00:00", 5), ("building", "2024-01-01 01:00:00", 110),
        ("data_center", "2024-01-01 01:00:00", 35), ("building", "2024-01-01 02:00:00", 120),
        ("data_center", "2024-01-01 03:00:00", 40), ("solar", "2024-01-01 04:00:00", 9),
        ("building", "2024-01-01 05:00:00", None), ("data_center", "2024-01-01 05:00:00", 50),
    )


def test_office_keeps_every_time(gappy):
    assert values(readings.office_load(gappy), "ts", "kilowatt") == [
        ("2024-01-01 00:00:00", "75.00"), ("2024-01-01 01:00:00", "75.00"),
        ("2024-01-01 02:00:00", "120.00"), ("2024-01-01 03:00:00", "-40.00"),
        ("2024-01-01 04:00:00", "9.00"), ("2024-01-01 05:00:00", "-50.00")]


def test_readings_need_building_and_data_center(gappy):
    got = readings.join_readings(gappy)
    assert values(got, "ts", "building", "solar", "office", "band", "dow") == [
        ("2024-01-01 00:00:00", "100.00", "5.00", "75.00", "1", "1"),
        ("2024-01-01 01:00:00", "110.00", "0.00", "75.00", "1", "1"),
        ("2024-01-01 05:00:00", "0.00", "0.00", "-50.00", "1", "1")]
    assert dict(got.dtypes)["office"] == "decimal(18,2)"
    empty = readings.join_readings(gappy, solar_missing="null")
    assert values(empty, "solar") == [("5.00",), ("None",), ("None",)]
    with pytest.raises(ValueError):
        readings.join_readings(gappy, solar_missing="carry")


def test_readings_equal_the_join_form(gappy):
    e, dc, pv = (
        gappy.where(F.col("feed") == f).select("ts", F.col("kilowatt").alias(f))
        for f in ("building", "data_center", "solar")
    )
    zero = F.lit(0).cast(KW)
    joined = e.join(dc, "ts").join(pv, "ts", "left").select(
        "ts", *[F.coalesce(f, zero).alias(f) for f in ("building", "data_center", "solar")])
    same_rows(readings.join_readings(gappy).select(*joined.columns), joined)


def test_duplicates_drop_in_the_same_shuffle(gappy, feed_rows):
    later = feed_rows(("building", "2024-01-01 00:00:00", 999), ("building", "2024-01-01 05:00:00", 7))
    doubled = gappy.unionByName(later.withColumn("seq", F.col("seq") + 1000))
    wide = readings.side_by_side(doubled, order="seq")
    same_rows(wide, readings.side_by_side(gappy))
    same_rows(readings.feed_rows(wide), gappy.drop("seq"))


def test_readings_take_one_shuffle(spark, gappy, tmp_path):
    gappy.write.parquet(str(tmp_path / "f"))
    plan = readings.join_readings(spark.read.parquet(str(tmp_path / "f")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "SortAggregate" not in plan


def hour_of_ramp(spark, start="2024-01-01 10:00:00", end="2024-01-01 10:55:00"):
    bounds = spark.sql(f"SELECT feed, TIMESTAMP_NTZ '{start}' AS start, TIMESTAMP_NTZ '{end}' AS end "
                       "FROM VALUES ('building'), ('data_center'), ('solar') AS t(feed)")
    return ramp.ramp_feed(bounds, F.lit(100000), F.lit(0.41))


def test_ramp_hour(spark):
    feeds = hour_of_ramp(spark)
    assert feeds.count() == 36
    row = buckets.delta(readings.join_readings(feeds), "hour").first()
    assert {str(row[m]) for m in METERS} == {"4.51"}


def test_ramp_has_both_ends_and_an_origin(spark):
    bounds = spark.sql("SELECT 'building' AS feed, TIMESTAMP_NTZ '2023-12-01 00:00:00' AS start, "
                       "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS end")
    df = ramp.ramp_feed(bounds, F.lit(100000), F.lit(0.41))
    assert df.count() == 31 * 288 + 1 and df.select("ts").distinct().count() == 8929
    shifted = ramp.ramp_feed(bounds, F.lit(0), F.lit(1), origin=F.lit("2023-11-30 23:00:00"))
    assert str(shifted.orderBy("ts").first()["kilowatt"]) == "12.00"


def test_single_reading_gives_zero_and_is_dropped(reading_rows):
    agg = buckets.delta(reading_rows(("2024-01-01 10:00:00", 5, 3, 1)), "hour")
    assert values(agg, "building", "office") == [("0.00", "0.00")]
    assert buckets.drop_empty(agg).count() == 0


def test_drop_empty_ignores_solar_and_drops_missing(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, 0.0, 0.0, 5.0, 0.0), (2, 0.0, 1.0, 0.0, 0.0), (3, NULL, 1.0, 0.0, 2.0), (4, 1.0, 1.0, NULL, 0.0)
        AS t(id, building, data_center, solar, office)""")
    assert values(buckets.drop_empty(df), "id") == [("2",), ("4",)]


@pytest.fixture
def spread(reading_rows):
    """Readings that cross bands, days, months and years."""
    rows, b, d, s = [], 1000, 400, 10
    for i, t in enumerate(
        ["2023-12-31 08:10:00", "2023-12-31 08:50:00", "2023-12-31 09:05:00", "2023-12-31 18:59:00",
         "2023-12-31 19:00:00", "2023-12-31 23:55:00", "2024-01-01 00:00:00", "2024-01-01 00:30:00",
         "2024-01-01 12:00:00", "2024-01-31 12:00:00", "2024-02-01 06:00:00", "2024-02-01 06:20:00"]):
        rows.append((t, b + 7 * i * i, d + 3 * i, s + (i % 4)))
    return reading_rows(*rows)


@pytest.mark.parametrize("grain", ["hour", "day", "month", "year", "band"])
def test_rollup_of_hour_states_equals_direct(spread, grain):
    state = buckets.bucket_state(spread, "hour")
    same_rows(buckets.state_delta(buckets.roll_state(state, grain), grain), buckets.delta(spread, grain))


@pytest.mark.parametrize("grain", ["month", "year", "day"])
def test_delta_equals_the_self_join_form(spread, grain):
    period = F.date_trunc(grain, "ts").cast("timestamp_ntz")
    ends = spread.groupBy(period.alias("p")).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    a = spread.select(F.col("ts").alias("lo"), *[F.col(m).alias(f"a_{m}") for m in METERS])
    z = spread.select(F.col("ts").alias("hi"), *[F.col(m).alias(f"z_{m}") for m in METERS])
    want = ends.join(a, "lo").join(z, "hi").select(
        F.col("p").alias("ts"), *[(F.col(f"z_{m}") - F.col(f"a_{m}")).cast(KW).alias(m) for m in METERS])
    same_rows(buckets.delta(spread, grain).select(*want.columns), want)


def test_window_form_equals_group_form(spread):
    same_rows(buckets.delta_by_window(spread), buckets.delta(spread, "hour"))
    w = (Window.partitionBy(F.date_trunc("hour", "ts")).orderBy("ts")
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    plain = spread.select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"),
        *[(F.last(m).over(w) - F.first(m).over(w)).cast(KW).alias(m) for m in METERS],
        "dow").distinct()
    same_rows(plain, buckets.delta(spread, "hour"))


def test_bucket_keys_are_unique(spread):
    for grain in ("hour", "day", "month", "year", "band"):
        agg = buckets.delta(spread, grain)
        assert agg.count() == agg.select(*buckets.key_columns(grain)).distinct().count()


def test_aggregation_stays_in_hash_form(spark, spread, tmp_path):
    spread.write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    plan = buckets.delta(stored, "hour")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan
    assert "SortAggregate" not in plan and "Window" not in plan


def test_day_delta_covers_its_hours(spread):
    day = buckets.delta(spread, "day").select("ts", F.col("building").alias("whole"))
    hours = buckets.delta(spread, "hour").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.sum("building").alias("parts"))
    assert day.join(hours, "ts").where("whole < parts").count() == 0


def test_period_ends(spread):
    got = buckets.period_ends(spread, "month")
    assert values(got, "edge", "ts") == [
        ("first", "2023-12-31 08:10:00"), ("first", "2024-01-01 00:00:00"), ("first", "2024-02-01 06:00:00"),
        ("last", "2023-12-31 23:55:00"), ("last", "2024-01-31 12:00:00"), ("last", "2024-02-01 06:20:00")]
    bands = buckets.period_ends(spread, "band")
    assert bands.where("edge = 'first'").count() == buckets.delta(spread, "band").count()


def test_order_head_and_year(spread):
    band = buckets.delta(spread, "band")
    assert [r["day"] for r in buckets.in_order(band, "band").collect()][0] == date(2023, 12, 31)
    assert [r["band"] for r in buckets.first_rows(band, 2, "day", "band").collect()] == [1, 2]
    assert {r["ts"].year for r in buckets.in_year(spread, 2024).collect()} == {2024}


def test_year_filter_reaches_the_scan(spark, spread, tmp_path):
    spread.write.parquet(str(tmp_path / "r"))
    df = buckets.in_year(spark.read.parquet(str(tmp_path / "r")), 2024).select("ts", "office")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01" in plan and "LessThan(ts,2025-01-01" in plan
    assert "building" not in plan


def test_sites_stay_apart(spread):
    two = spread.withColumn("site", F.lit(1)).unionByName(
        spread.withColumn("site", F.lit(2)).withColumn("building", (F.col("building") * 2).cast(KW)))
    one = buckets.delta(spread, "day")
    got = buckets.delta(two, "day", ["site"])
    same_rows(got.where("site = 1").drop("site"), one)
    doubled = got.where("site = 2").agg(F.sum("building")).first()[0]
    assert doubled == 2 * one.agg(F.sum("building")).first()[0]


def test_clock_change_hour(reading_rows):
    agg = buckets.delta(reading_rows(("2024-03-31 02:00:00", 1, 1, 0), ("2024-03-31 02:30:00", 3, 1, 0)), "hour")
    assert agg.first()["ts"] == datetime(2024, 3, 31, 2)


def test_carry_loses_nothing_between_buckets(reading_rows):
    df = reading_rows(("2024-01-01 00:10:00", 1, 0, 0), ("2024-01-01 00:50:00", 4, 0, 0),
                      ("2024-01-01 01:05:00", 6, 0, 0), ("2024-01-01 03:30:00", 11, 0, 0))
    for mode, want in (("within", [3, 0, 0]), ("carry", [3, 2, 5])):
        got = buckets.delta(df, "hour", mode=mode).orderBy("ts").collect()
        assert [int(r["building"]) for r in got] == want
