from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from wattspan.operators import clean
from wattspan.sources import load_log


def rows(df):
    return sorted((r["feed"], str(r["ts"]), float(r["kilowatt"])) for r in df.collect())


def test_align_stops_at_the_shortest_feed(feed_rows):
    df = feed_rows(
        ("building", "2024-01-01 00:00:00", 1), ("building", "2024-01-01 02:00:00", 2),
        ("solar", "2024-01-01 00:00:00", 1), ("solar", "2024-01-01 01:00:00", 2),
    )
    assert [r[1] for r in rows(clean.align_feeds(df))] == [
        "2024-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-01 01:00:00"]


def test_align_by_site(feed_rows):
    a = feed_rows(("building", "2024-01-01 00:00:00", 1), ("solar", "2024-01-01 05:00:00", 1))
    b = feed_rows(("building", "2024-01-01 09:00:00", 1), ("solar", "2024-01-01 08:00:00", 1))
    df = a.withColumn("site", F.lit(1)).unionByName(b.withColumn("site", F.lit(2)))
    got = sorted((r["site"], r["feed"]) for r in clean.align_feeds(df, ["site"]).collect())
    assert got == [(1, "building"), (2, "solar")]


def test_align_pushes_the_horizon_into_the_scan(spark, feed_rows, tmp_path):
    path = str(tmp_path / "feeds")
    feed_rows(("building", "2024-01-01 00:00:00", 1)).write.parquet(path)
    df = clean.align_feeds(spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ts,ScalarSubquery" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dedup_keeps_the_first_read(feed_rows):
    df = feed_rows(
        ("building", "2024-01-01 00:00:00", 5), ("building", "2024-01-01 00:00:00", 9),
        ("solar", "2024-01-01 00:00:00", 7),
    ).repartition(4, "kilowatt")
    got = clean.dedup_feed(df)
    assert rows(got) == [("building", "2024-01-01 00:00:00", 5.0), ("solar", "2024-01-01 00:00:00", 7.0)]
    assert got.columns == df.columns


def test_dedup_keeps_a_first_value_that_is_missing(feed_rows):
    df = feed_rows(("building", "2024-01-01 00:00:00", None), ("building", "2024-01-01 00:00:00", 9))
    assert clean.dedup_feed(df).first()["kilowatt"] is None


def test_dedup_combines_before_the_shuffle(feed_rows):
    df = clean.dedup_feed(feed_rows(("building", "2024-01-01 00:00:00", 1)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_new_rows_follow_the_latest_record(spark, feed_rows):
    df = feed_rows(*[("building", f"2024-01-0{d} 00:00:00", d) for d in (1, 2, 3)])
    log = spark.createDataFrame(
        [(at("2024-02-01 00:00:00"), at("2024-01-01 00:00:00"), at("2024-01-01 00:00:00")),
         (at("2024-02-02 00:00:00"), at("2024-01-01 00:00:00"), at("2024-01-02 00:00:00"))],
        "downloaded_at timestamp_ntz, start timestamp_ntz, end timestamp_ntz")
    assert [r[2] for r in rows(clean.new_rows(df, log))] == [3.0]
    assert clean.new_rows(df, log.limit(0)).count() == 3


def test_load_window_and_log(spark, feed_rows, tmp_path):
    df = feed_rows(("building", "2024-01-01 00:00:00", 1), ("solar", "2024-01-03 00:00:00", 1))
    assert clean.load_window(df).count() == 2
    path = str(tmp_path / "log")
    stamp = F.lit("2024-02-01 00:00:00")
    load_log.append_log(load_log.log_entry(df, stamp), path)
    load_log.append_log(load_log.log_entry(df.limit(0), stamp), path)
    (row,) = load_log.read_log(spark, path).collect()
    assert (row["start"], row["end"]) == (datetime(2024, 1, 1), datetime(2024, 1, 3))


def test_state_file(spark, tmp_path):
    file = tmp_path / "state.json"
    file.write_text('[{"data_di_download": "2024-02-01 10:00:00.123", "data_inizio": "2024-01-01 00:00:00",'
                    ' "data_fine": "2024-01-31 00:00:00"}, {"data_di_download": "2024-03-01 10:00:00",'
                    ' "data_inizio": "", "data_fine": ""}]')
    got = load_log.read_state_file(spark, str(file)).orderBy("downloaded_at").collect()
    assert got[0]["end"] == datetime(2024, 1, 31) and got[1]["end"] is None


@pytest.mark.parametrize("keys", [(), ("site",)])
def test_align_of_nothing(feed_rows, keys):
    df = feed_rows(("building", "2024-01-01 00:00:00", 1)).withColumn("site", F.lit(1)).limit(0)
    assert clean.align_feeds(df, keys).count() == 0
