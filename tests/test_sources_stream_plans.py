from __future__ import annotations

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, kw
from wattspan import session
from wattspan.operators import buckets, clean, prep, readings, remote, weather
from wattspan.plans import load as plan
from wattspan.operators import ensemble
from wattspan.plans import predict
from wattspan.plans.store import Store
from wattspan.schema import READINGS, WEATHER
from wattspan.sources import load_log, meter_csv, tables
from wattspan.streaming import feeds as streaming

SMALL = (
    {"trees": (3,), "depth": (3,), "least": (2,)}, {"rounds": (2,), "leaves": (4,), "kind": ("gbdt",)},
)



def same_rows(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_csv_roundtrip_and_append(spark, feed_rows, tmp_path):
    path = str(tmp_path / "building")
    df = feed_rows(("building", "2024-01-01 00:00:00", 1.5), ("building", "2024-01-01 00:05:00", None))
    meter_csv.write_feed(df, path)
    meter_csv.write_feed(feed_rows(("building", "2024-01-01 00:10:00", 2)), path, mode="append")
    got = meter_csv.read_feed(spark, path, "building")
    assert sorted((str(r["ts"]), str(r["kilowatt"])) for r in got.collect()) == [
        ("2024-01-01 00:00:00", "1.50"), ("2024-01-01 00:05:00", "None"), ("2024-01-01 00:10:00", "2.00")]


def test_csv_is_read_by_position_and_rounds(spark, tmp_path):
    file = tmp_path / "f.csv"
    file.write_text("data,value\n2024-01-01 00:00:00,1.005\n2024-01-01 00:05:00,2.125\n")
    got = meter_csv.read_feed(spark, str(file), "solar").orderBy("ts").collect()
    assert [str(r["kilowatt"]) for r in got][1] == "2.13" and got[0]["feed"] == "solar"


@pytest.mark.parametrize("line", ["2024-01-01 00:05:00,abc", ",5.0", "not a time,5.0"])
def test_csv_bad_lines_fail(spark, tmp_path, line):
    file = tmp_path / "f.csv"
    file.write_text(f"Date,kilowatt\n2024-01-01 00:00:00,1\n{line}\n")
    with pytest.raises(Exception):
        meter_csv.read_feed(spark, str(file), "solar").collect()


def test_file_order_survives_splitting(spark, tmp_path):
    file = tmp_path / "f.csv"
    lines = [f"2024-01-01 00:{i % 60:02d}:00,{i}" for i in range(6000)]
    file.write_text("Date,kilowatt\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = meter_csv.read_feed(spark, str(file), "building")
        assert rows.rdd.getNumPartitions() > 3
        seen = [int(r["kilowatt"]) for r in rows.orderBy("seq").collect()]
        firsts = {int(r["kilowatt"]) for r in clean.dedup_feed(rows).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen == list(range(6000)) and firsts == set(range(60))


def test_forecast_sample(spark, tmp_path):
    file = tmp_path / "s.csv"
    file.write_text("data,fascia_oraria,giorno_settimana,previsioni\n08/03/2024,1,4,699.4745\n")
    row = meter_csv.read_forecast_sample(spark, str(file)).first()
    assert (str(row["day"]), row["band"], row["dow"], row["building_forecast"]) == ("2024-03-08", 1, 4, 699.4745)


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert a.startswith(base) and a != b


def test_append_new_and_rewrite(spark, feed_rows, tmp_path):
    path = str(tmp_path / "t")
    first = feed_rows(("building", "2024-01-31 00:00:00", 1), ("building", "2024-02-01 00:00:00", 2))
    second = feed_rows(("building", "2024-02-01 00:00:00", 9), ("building", "2024-03-01 00:00:00", 3))
    for batch in (first, second, second):
        tables.append_new(batch, path, ["feed", "ts"])
    stored = {str(r["ts"])[:7]: float(r["kilowatt"]) for r in tables.read(spark, path).collect()}
    assert stored == {"2024-01": 1, "2024-02": 2, "2024-03": 3}
    assert {f.split("period=")[1][:6] for f in tables.months(spark, path, 202402, 202402).inputFiles()} == {"202402"}
    tables.rewrite(spark, path, (202402, 202402), lambda t: t.withColumn("kilowatt", F.lit(7).cast("decimal(10,2)")))
    after = {str(r["ts"])[:7]: float(r["kilowatt"]) for r in tables.read(spark, path).collect()}
    assert after == {"2024-01": 1, "2024-02": 7, "2024-03": 3}
    tables.append_new(first.limit(0), path, ["feed", "ts"])


def ramps(spark, first="2024-01-29", days=6, minutes=20):
    """Three feeds with different slopes over days that cross a month; solar has gaps."""
    start = at(first + " 00:00:00")
    rows = []
    for i in range(days * 24 * 60 // minutes):
        t = start + timedelta(minutes=minutes * i)
        busy = 9 <= t.hour < 19 and t.weekday() < 5
        rows.append(("building", t, 1000 + 3 * i + (i * i % 50 if busy else 0)))
        rows.append(("data_center", t, 100 + i))
        if i % 3:
            rows.append(("solar", t, 50 + i // 2))
    data = [(f, n, t, v) for n, (f, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "feed string, seq bigint, ts timestamp_ntz, v int").withColumn(
        "kilowatt", F.col("v").cast("decimal(10,2)")).drop("v")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw feeds and weather on disk, and a store loaded with all of them."""
    root = tmp_path_factory.mktemp("stored")
    start = at("2024-01-29 00:00:00")
    hours = [(start + timedelta(hours=i), *[float(i % 30 + v) for v in range(23)]) for i in range(7 * 24)]
    spark.createDataFrame(hours, WEATHER).write.parquet(str(root / "weather"))
    ramps(spark).write.parquet(str(root / "raw"))
    raw, weather_hours = (spark.read.parquet(str(root / n)) for n in ("raw", "weather"))
    store = Store(str(root / "store"))
    assert plan.load(raw, store, weather_hours, downloaded_at=F.lit("2024-02-05 00:00:00"))
    return raw, weather_hours, store


def test_stream_loads_only_new_files(spark, feed_rows, tmp_path):
    folder, table, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    first = feed_rows(("building", "2024-01-01 00:00:00", 1), ("building", "2024-01-01 00:00:00", 2))
    second = feed_rows(("building", "2024-01-01 00:00:00", 5), ("building", "2024-01-01 01:00:00", 3))
    for drop in (first, second):
        drop.write.mode("append").parquet(folder)
        streaming.load_new_files(streaming.stream_files(spark, folder, first.schema), table, ckpt)
    got = {r["ts"].hour: float(r["kilowatt"]) for r in tables.read(spark, table).collect()}
    assert got == {0: 1.0, 1: 3.0}


def test_stream_hours_equal_batch(spark, tmp_path):
    rows = readings.join_readings(ramps(spark, days=2))
    folder, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rows.repartition(6, "ts").write.parquet(folder)
    stream = streaming.stream_files(spark, folder, READINGS, files_per_trigger=2)
    streaming.write_updates(streaming.hourly_delta(stream, "10 days"), out, ckpt)
    same_rows(streaming.latest(spark, out, ["ts"]), buckets.delta(rows, "hour"))


def test_late_rows_are_dropped_after_the_watermark(spark, reading_rows, tmp_path):
    folder, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for batch in (
        reading_rows(("2024-01-01 10:00:00", 1, 1, 0), ("2024-01-01 10:30:00", 5, 1, 0)),
        reading_rows(("2024-01-03 10:00:00", 9, 1, 0)),
        reading_rows(("2024-01-01 10:50:00", 99, 1, 0), ("2024-01-03 10:30:00", 12, 1, 0)),
    ):
        batch.coalesce(1).write.mode("append").parquet(folder)
        stream = streaming.stream_files(spark, folder, READINGS)
        streaming.write_updates(streaming.hourly_delta(stream, "1 hour"), out, ckpt)
    got = {r["ts"].day: float(r["building"]) for r in streaming.latest(spark, out, ["ts"]).collect()}
    assert got == {1: 4.0, 3: 3.0}


def test_load_in_one_go(spark, stored):
    raw, month_weather, store = stored
    joined = readings.join_readings(raw)
    same_rows(tables.read(spark, store.readings), joined)
    same_rows(tables.read(spark, store.office), readings.office_load(raw))
    hour = weather.merge_weather(buckets.drop_empty(buckets.delta(joined, "hour")), month_weather, "hour")
    same_rows(tables.read(spark, store.agg("hour")), hour)
    bands = weather.merge_weather(buckets.drop_empty(buckets.delta(joined, "band")), month_weather, "band")
    flags = remote.band_flags(bands)
    same_rows(plan.classified(spark, store, "band"), remote.flag_bands(bands, flags))
    month = plan.classified(spark, store, "month")
    assert {str(r["ts"])[:7] for r in month.collect()} == {"2024-01", "2024-02"}
    assert all(r["remote_pct"] for r in month.where("building IS NOT NULL").collect())
    assert tables.read(spark, store.agg("hour")).where("building IS NULL").count() == 24
    assert not plan.load(raw, store, month_weather)
    base = spark.conf.get("spark.checkpoint.dir")
    assert not [n for n in os.listdir(base) if n.startswith(("side_by_side", "flags"))]


def test_second_load_keeps_first_buckets(spark, stored, tmp_path):
    raw, _, once = stored
    cut = F.lit("2024-01-31 10:30:00").cast("timestamp_ntz")
    twice = Store(str(tmp_path / "twice"))
    plan.load(raw.where(F.col("ts") < cut), twice)
    early = tables.read(spark, twice.agg("month")).first()["building"]
    assert plan.load(raw, twice)
    same_rows(tables.read(spark, twice.readings), tables.read(spark, once.readings))
    same_rows(tables.read(spark, twice.feeds), tables.read(spark, once.feeds))
    same_rows(tables.read(spark, twice.hour_state), tables.read(spark, once.hour_state))
    # The hour, day, month and year open at the first load keep their early values.
    meters = ["ts", "building", "data_center", "solar", "office", "dow"]
    a, b = (
        tables.read(spark, s.agg("hour")).where("building IS NOT NULL").select(*meters)
        for s in (once, twice)
    )
    assert [r["ts"] for r in a.exceptAll(b).collect()] == [datetime(2024, 1, 31, 10)]
    assert a.count() == b.count()
    january = tables.read(spark, twice.agg("month")).where("ts < TIMESTAMP_NTZ '2024-02-01 00:00:00'").first()
    assert january["building"] == early
    full = tables.read(spark, once.agg("month")).where("ts < TIMESTAMP_NTZ '2024-02-01 00:00:00'").first()
    assert full["building"] > early


def test_load_that_moves_no_meter(spark, feed_rows, tmp_path):
    store = Store(str(tmp_path / "still"))
    still = feed_rows(*[(f, "2024-01-01 10:00:00", 5) for f in ("building", "data_center")])
    assert plan.load(still, store)
    assert not tables.exists(spark, store.agg("hour")) and tables.read(spark, store.readings).count() == 1
    more = feed_rows(*[(f, f"2024-01-01 10:{m}:00", m) for f in ("building", "data_center") for m in (10, 40)])
    assert plan.load(still.unionByName(more.withColumn("seq", F.col("seq") + 100)), store)
    assert str(tables.read(spark, store.agg("hour")).first()["building"]) == "35.00"


def test_load_by_site(spark, stored, tmp_path):
    raw, weather_hours, alone = stored
    two = raw.withColumn("site", F.lit(1)).unionByName(raw.withColumn("site", F.lit(2)))
    both = weather_hours.withColumn("site", F.explode(F.array(F.lit(1), F.lit(2))))
    store = Store(str(tmp_path / "two"))
    plan.load(two, store, both, keys=["site"])
    for grain in ("hour", "band", "month"):
        got = plan.classified(spark, store, grain, ["site"])
        same_rows(got.where("site = 2").drop("site"), plan.classified(spark, alone, grain))
    predict.train(spark, store, *SMALL, folds=2, search_folds=2, keys=["site"])
    ahead = predict.forecast(spark, store, both, F.lit("2024-02-03 12:00:00"), days=1, keys=["site"])
    assert sorted(r["site"] for r in ahead.collect()) == [1] * 6 + [2] * 6


def test_site_that_lags_loses_nothing(spark, tmp_path):
    rows = ramps(spark, days=4, minutes=60)
    two = rows.withColumn("site", F.lit(1)).unionByName(rows.withColumn("site", F.lit(2)))
    late = (F.col("site") == 2) & (F.col("ts") >= at("2024-01-30 06:00:00"))
    early = (F.col("site") == 1) & (F.col("ts") >= at("2024-02-01 00:00:00"))
    store = Store(str(tmp_path / "lag"))
    assert plan.load(two.where(~late & ~early), store, keys=["site"])
    assert plan.load(two, store, keys=["site"])
    got = {r["site"]: r["count"] for r in tables.read(spark, store.readings).groupBy("site").count().collect()}
    assert got == {1: 96, 2: 96}
    assert not plan.load(two, store, keys=["site"])


def test_weather_columns_outlive_a_load_without_weather(spark, stored, tmp_path):
    raw, hours, _ = stored
    cut = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    for first_has_it in (True, False):
        store = Store(str(tmp_path / f"weather-{first_has_it}"))
        plan.load(raw.where(F.col("ts") < cut), store, hours if first_has_it else None)
        plan.load(raw, store, None if first_has_it else hours)
        for grain in ("hour", "band", "month"):
            table = tables.read(spark, store.agg(grain))
            assert "rain" in table.columns and table.where("rain IS NOT NULL").count() > 0


def test_recompute_equals_one_load(spark, stored, tmp_path):
    raw, hours, once = stored
    cut = F.lit("2024-01-31 10:30:00").cast("timestamp_ntz")
    store = Store(str(tmp_path / "again"))
    plan.load(raw.where(F.col("ts") < cut), store, hours, open_buckets=plan.RECOMPUTE)
    plan.load(raw, store, hours, open_buckets=plan.RECOMPUTE)
    for grain in ("hour", "day", "band", "month", "year"):
        same_rows(plan.classified(spark, store, grain), plan.classified(spark, once, grain))


def test_write_that_fails_leaves_the_table(spark, feed_rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.append_new(feed_rows(("building", "2024-01-31 00:00:00", 1)), path, ["feed", "ts"])

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "_publish", lost)
    with pytest.raises(RuntimeError):
        tables.rewrite(spark, path, (202401, 202401), lambda t: t.withColumn("kilowatt", F.lit(9)))
    monkeypatch.undo()
    assert float(tables.read(spark, path).first()["kilowatt"]) == 1
    tables.rewrite(spark, path, (202401, 202401), lambda t: t.where("false"))
    assert not tables.exists(spark, path) and tables.read(spark, path).count() == 0


def test_rows_of_a_folder_have_one_order(spark, feed_rows, tmp_path):
    path = str(tmp_path / "feed")
    for value in (1, 2):
        meter_csv.write_feed(feed_rows(("building", "2024-01-01 00:00:00", value)), path, mode="append")
        time.sleep(1.1)
    rows = meter_csv.read_feed(spark, path, "building")
    assert rows.select("seq").distinct().count() == 2
    assert float(clean.dedup_feed(rows).first()["kilowatt"]) == 1


def test_register_beyond_a_hundred_million(spark, feed_rows):
    rows = feed_rows(*[(f, f"2024-01-01 00:{m}:00", v) for f in ("building", "data_center")
                       for m, v in ((10, 150_000_000), (50, 150_000_321.5))])
    assert str(buckets.delta(readings.join_readings(rows), "month").first()["building"]) == "321.50"


def test_state_file_is_read_and_appended(spark, feed_rows, tmp_path):
    path = str(tmp_path / "state")
    for day in (1, 2):
        rows = feed_rows(("building", f"2024-01-0{day} 10:00:00", 1))
        load_log.append_state_file(load_log.log_entry(rows, F.lit(f"2024-01-0{day + 1} 00:00:00")), path)
    got = load_log.read_state_file(spark, path).orderBy("downloaded_at").collect()
    assert [str(r["end"]) for r in got] == ["2024-01-01 10:00:00", "2024-01-02 10:00:00"]


def test_train_and_forecast(spark, stored, monkeypatch):
    _, month_weather, store = stored
    errors = predict.train(spark, store, *SMALL, folds=2, search_folds=2)
    assert {r["model"] for r in errors.collect()} == {"forest", "boosted", "stack"}
    as_of = F.lit("2024-02-03 12:00:00")

    def rows():
        return tables.read_parts(spark, store.forecasts).count()

    first = predict.forecast(spark, store, month_weather, as_of, days=1)
    assert first.count() == 6
    predict.forecast(spark, store, month_weather, as_of, days=1)
    assert rows() == 6  # the run replaced its own rows
    predict.forecast(spark, store, month_weather, F.lit("2024-02-02 12:00:00"), days=1)
    assert rows() == 12
    refit = predict.forecast(spark, store, month_weather, as_of, days=1, refit_scaler=True)
    assert refit.count() == 6 and set(refit.columns) == set(first.columns)


def test_training_that_dies_leaves_the_old_model(spark, stored, monkeypatch):
    _, month_weather, store = stored
    predict.train(spark, store, *SMALL, folds=2, search_folds=2)
    before = ensemble.load(spark, store.model)

    def dies(spark, stack, folder):
        written(spark, stack, folder)
        raise RuntimeError("killed before the switch")

    written = ensemble.write
    monkeypatch.setattr(ensemble, "write", dies)
    with pytest.raises(RuntimeError, match="killed"):
        predict.train(spark, store, {**SMALL[0], "trees": (7,)}, SMALL[1], folds=2, search_folds=2)
    held = ensemble.load(spark, store.model)
    assert len(held.forest.trees) == len(before.forest.trees) == 3
    assert held.weights == before.weights


def test_flags_are_kept_up_by_months(spark, tmp_path):
    """Loads month by month give the flags of one load, and read no month they do not touch."""
    start = at("2024-01-01 00:00:00")

    def raw(first, last):
        rows = []
        for day in range(first, last):
            t = start + timedelta(days=day)
            month, work = t.month, t.weekday() < 5
            for hour in (9, 18):
                # Whole registers; the office load of a day is its building load. Every fifth
                # workday or so lies about the threshold.
                busy = 40 + 3 * (day % 7) if day % 5 else 9 + day % 9
                spent = (busy if work else 5 + month) if hour == 18 else 0
                rows += [("building", t.replace(hour=hour), 1000 * day + spent), ("data_center", t.replace(hour=hour), 7)]
        data = [(f, n, ts, kw(v)) for n, (f, ts, v) in enumerate(rows)]
        return spark.createDataFrame(data, "feed string, seq bigint, ts timestamp_ntz, kilowatt decimal(18,2)")

    once, steps = Store(str(tmp_path / "once")), Store(str(tmp_path / "steps"))
    assert plan.load(raw(0, 150), once)
    for until in (45, 90, 150):
        assert plan.load(raw(0, until), steps)
        # What was flagged before is what one load of the same days flags.
        whole = remote.band_flags(tables.read(spark, steps.agg("band")))
        same_rows(tables.read(spark, steps.flags), whole)
    same_rows(tables.read(spark, steps.flags), tables.read(spark, once.flags))
    assert {r["remote_flag"] for r in tables.read(spark, steps.flags).collect()} == {"OK", "KO", "NA"}

    flagged = {m: f for m, f in tables._current(spark, steps.flags)[1]["months"].items()}
    assert plan.load(raw(0, 152), steps)  # a weekend more, which hardly moves the threshold
    after = tables._current(spark, steps.flags)[1]["months"]
    assert [m for m in flagged if after[m] != flagged[m]] in (["202405"], [])
    same_rows(tables.read(spark, steps.flags), remote.band_flags(tables.read(spark, steps.agg("band"))))


def test_sketches_are_kept_up_by_months(spark, tmp_path):
    """A load sketches the months it touches; limits by the sketches are those of all hours."""
    raw, store = ramps(spark), Store(str(tmp_path))
    until = F.lit("2024-02-02").cast("timestamp_ntz")
    assert plan.load(raw.where(F.col("ts") < until), store)
    first = tables._current(spark, store.sketches("hour"))[1]["months"]
    assert sorted(first) == ["202401", "202402"]
    assert plan.load(raw, store)
    second = tables._current(spark, store.sketches("hour"))[1]["months"]
    assert second["202401"] == first["202401"] and second["202402"] != first["202402"]
    hours = tables.read(spark, store.agg("hour"))
    same_rows(plan.usual_hours(spark, store, "building", 0.9), prep.filter_outliers(hours, "building", 0.9))
    quarters = ("name", "count", "min", "q25", "q50", "q75", "max")
    whole = prep.describe(hours, ["building", "data_center", "solar", "office"])
    same_rows(plan.summary(spark, store).select(*quarters), whole.select(*quarters))


def test_months_are_flagged_again_when_the_threshold_crosses_a_load(spark):
    days = [("2024-01-02", 2, 2, 50), ("2024-02-01", 2, 4, 60), ("2024-03-01", 2, 5, 60), ("2024-03-02", 2, 6, 1)]
    bands = spark.createDataFrame(days, "d string, band int, dow int, o int").select(
        F.to_date("d").alias("day"), "band", "dow", F.col("o").cast("decimal(18,2)").alias("office"))

    def at_level(x):
        return spark.createDataFrame([(x,)], "threshold double")

    states = remote.month_states(bands, at_level(55.0))
    for level, months in ((54.0, []), (50.0, ["2024-01-01"]), (60.0, ["2024-02-01", "2024-03-01"]), (45.0, ["2024-01-01"]),
                          (None, ["2024-01-01", "2024-02-01", "2024-03-01"])):
        found = remote.months_to_flag(states, at_level(level)).collect()
        assert sorted(str(r["day"]) for r in found) == months, level
    unjudged = remote.month_states(bands, at_level(None))
    assert remote.months_to_flag(unjudged, at_level(None)).isEmpty()
    assert remote.months_to_flag(unjudged, at_level(1.0)).count() == 3


def test_a_load_reads_raw_rows_once(spark, tmp_path):
    rows = ramps(spark, days=3, minutes=60)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    raw = rows.repartition(3).mapInArrow(counted, rows.schema)
    store = Store(str(tmp_path / "once"))
    assert plan.load(raw, store)
    assert read.value == rows.count()


def test_a_feed_without_new_rows_holds_the_load_back(spark, tmp_path):
    rows = ramps(spark, days=4, minutes=60)
    cut = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    store = Store(str(tmp_path / "held"))
    assert plan.load(rows.where(F.col("ts") < cut), store)
    early = (F.col("feed") == "data_center") & (F.col("ts") >= cut)
    assert not plan.load(rows.where(~early), store)
    # A drop with new rows only is aligned by what earlier ones brought.
    assert not plan.load(rows.where((F.col("ts") >= cut) & ~early), store)
    assert plan.load(rows.where(F.col("ts") >= cut), store)
    same_rows(tables.read(spark, store.readings), readings.join_readings(rows))


def test_many_loads_leave_few_folders(spark, feed_rows, tmp_path):
    path = str(tmp_path / "t")
    seen = None
    for n in range(50):
        tables.append_new(
            feed_rows(("building", f"2024-01-{n % 28 + 1:02d} {n // 28:02d}:00:00", n)), path, ["feed", "ts"], gather=False)
        before = tables.read(spark, path)  # resolved before the folders are joined
        if tables.compact(spark, path, keys=["feed"]):
            seen = n
            assert before.count() == n + 1
        assert len(tables._current(spark, path)[1]["months"]["202401"]) <= tables.FOLDERS
    assert seen is not None
    got = {int(r["kilowatt"]) for r in tables.read(spark, path).collect()}
    assert got == set(range(50)) and tables.read(spark, path).count() == 50
    assert len([x for x in os.listdir(path) if not x.startswith("_")]) <= 2 * tables.FOLDERS + 2
    # A large folder stays as it is.
    held = tables._current(spark, path)[1]["months"]["202401"]
    assert tables.compact(spark, path, most=0, large=1) == []
    assert tables._current(spark, path)[1]["months"]["202401"] == held
