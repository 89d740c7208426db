"""Hot keys: one key, hour or site holds most of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wattspan.operators import buckets, clean, prep, readings
from wattspan.schema import FEEDS, METERS

ROWS = 60_000


@pytest.fixture(scope="module")
def crowded(spark):
    """Most times fall in one hour of one site; a third of all rows copy a single reading."""
    j = F.floor(F.col("id") / 3)
    second = F.when(j % 8 != 0, j % 3600).otherwise((j * 60) % 86400)
    spread = spark.range(ROWS).select(
        F.element_at(F.array(*[F.lit(f) for f in FEEDS]), (F.col("id") % 3 + 1).cast("int")).alias("feed"),
        F.when(j % 10 == 0, 2).otherwise(1).alias("site"),
        F.col("id").alias("seq"),
        F.timestamp_seconds(F.lit(1704067200) + second).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 997).cast("decimal(10,2)").alias("kilowatt"),
    )
    copies = spark.range(ROWS // 2).select(
        F.lit("building").alias("feed"),
        F.lit(1).alias("site"),
        (F.col("id") + ROWS).alias("seq"),
        F.lit("2024-01-01 00:00:01").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 991).cast("decimal(10,2)").alias("kilowatt"),
    )
    return spread.unionByName(copies)


def test_copies_collapse_to_the_first(crowded):
    got = clean.dedup_feed(crowded, ["site", "feed", "ts"])
    want = crowded.groupBy("site", "feed", "ts").agg(F.min("seq").alias("seq")).join(
        crowded.select("seq", "kilowatt"), "seq")
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).isEmpty()


def test_crowded_hour_is_whole(crowded):
    wide = readings.side_by_side(crowded, ["site"], order="seq")
    rows = readings.readings_of(wide, ["site"])
    got = buckets.delta(rows, "hour", ["site"]).toPandas().set_index(["site", "ts"]).sort_index()
    pdf = rows.toPandas().sort_values("ts")
    pdf["hour"] = pdf["ts"].dt.floor("h")
    by = pdf.groupby(["site", "hour"])
    want = by[list(METERS)].last() - by[list(METERS)].first()
    assert len(got) == len(want) > 2
    for m in METERS:
        assert [float(v) for v in got[m]] == [float(v) for v in want[m]]


def test_window_form_of_a_crowded_hour(crowded):
    rows = readings.readings_of(readings.side_by_side(crowded, ["site"], order="seq"), ["site"])
    a = buckets.delta_by_window(rows, ["site"])
    b = buckets.delta(rows, "hour", ["site"]).select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_quantiles_with_one_dominant_value(spark):
    df = spark.range(30_001).select(
        F.when(F.col("id") % 3 != 0, F.lit(5)).otherwise(F.col("id")).cast("decimal(10,2)").alias("x"))
    pdf = df.toPandas()["x"].astype(float)
    for row in prep.quantiles(df, ["x"], [0.1, 0.5, 0.9, 0.99]).collect():
        assert row["value"] == pytest.approx(pdf.quantile(row["prob"]))
