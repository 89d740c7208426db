from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import FEED_SCHEMA, at, kw
from wattspan.operators import buckets
from wattspan.schema import METERS, READINGS
from wattspan.streaming import feeds


@pytest.fixture(autouse=True)
def on_disk(spark):
    feeds.keep_state_on_disk(spark)


def dropped(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return feeds.stream_files(spark, folder, spark.createDataFrame([], schema).schema)


def test_copies_in_later_batches_are_dropped_and_forgotten(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    start = at("2024-01-01 00:00:00")
    rows = [("building", i, start + timedelta(hours=i), kw(i)) for i in range(200)]
    held = []
    # Every drop repeats the last rows of the one before it, and holds copies of its own.
    for lo in range(0, 200, 40):
        drop = rows[max(0, lo - 5) : lo + 40]
        progress = feeds.write_updates(
            feeds.deduplicated(dropped(spark, folder, drop + drop[:3], FEED_SCHEMA), "12 hours"), out, checkpoint, "append"
        )
        held.append(progress["stateOperators"][0]["numRowsTotal"])
    got = spark.read.parquet(out).select("feed", "seq", "ts", "kilowatt").collect()
    assert sorted(map(tuple, got)) == rows
    assert max(held) <= 60  # keys of twelve hours and of one drop, not of the whole stream


def readings(days, busy=3):
    start = at("2024-03-01 00:00:00")
    for i in range(days * 96):
        t = start + timedelta(minutes=15 * i)
        yield (t, *[kw(k * i + (i * i) % (busy + k)) for k in range(4)], 1 + (t.hour >= 9) + (t.hour >= 19), t.isoweekday() % 7)


@pytest.mark.parametrize("grain", ["day", "band"])
def test_closed_windows_equal_the_batch(spark, tmp_path, grain):
    names = ("in", "timely", "late", "out", "dealing", "checkpoint")
    folder, timely, late, out, dealing, checkpoint = (str(tmp_path / n) for n in names)
    rows = list(readings(5))
    missed = rows[100:120]
    parts = [rows[:100] + rows[120:250], rows[250:400] + missed, rows[400:]]
    for part in parts:
        feeds.split_late(dropped(spark, folder, part, READINGS), timely, late, dealing, "2 HOURS")
        stream = feeds.stream_files(spark, timely, READINGS)
        feeds.write_updates(feeds.chained_delta(stream, grain, "2 hours"), out, checkpoint, "append")
    kept, behind = (spark.read.schema(READINGS).parquet(p) for p in (timely, late))
    assert sorted(map(tuple, behind.select(*READINGS.names).collect())) == missed
    assert kept.count() + behind.count() == len(rows)
    by = ["ts"] if grain == "day" else ["day", "band"]
    whole = buckets.delta(kept, grain)
    closed = whole.where(F.col(by[0]) < F.lit("2024-03-05").cast("timestamp_ntz"))
    got = spark.read.parquet(out).select(*by, *METERS, "dow")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.select(*by, *METERS, "dow").collect()))


def test_a_batch_dealt_again_gives_the_same(spark, tmp_path):
    names = ("in", "timely", "late", "dealing")
    folder, timely, late, dealing = (str(tmp_path / n) for n in names)
    rows = list(readings(2))
    for part in (rows[20:], rows[:20]):
        feeds.split_late(dropped(spark, folder, part, READINGS), timely, late, dealing, "1 HOUR")
    again = {p: spark.read.schema(READINGS).parquet(p).count() for p in (timely, late)}
    assert again == {timely: 172, late: 20}
    # The commit of the last batch is lost: it is dealt once more.
    commits = tmp_path / "dealing" / "stream" / "commits"
    for name in ("1", ".1.crc"):
        (commits / name).unlink(missing_ok=True)
    feeds.split_late(feeds.stream_files(spark, folder, READINGS), timely, late, dealing, "1 HOUR")
    assert {p: spark.read.schema(READINGS).parquet(p).count() for p in (timely, late)} == again
