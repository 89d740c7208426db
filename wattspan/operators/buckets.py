"""Consumption per bucket: last minus first value of a cumulative meter.

``bucket_state`` keeps the first and last reading of every bucket. The state is
mergeable, so coarser grains roll up from hours without reading the readings
again: every band edge and day, month and year start lies on a full hour. All
of it is hash aggregation with map-side partials; no bucket, however many rows
it holds, is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattspan.functions import calendar as cal
from wattspan.schema import KW, METERS

# Grains whose result carries the day of week.
WITH_DOW = ("hour", "day", "band")


def key_columns(grain: str, keys: Sequence[str] = ()) -> list[str]:
    return [*keys, *(("day", "band") if grain == "band" else ("ts",))]


def _grouped(df: DataFrame, time: Column, grain: str, keys: Sequence[str], aggs) -> DataFrame:
    by = [c.alias(n) for n, c in cal.bucket_columns(time, grain).items()]
    return df.groupBy(*keys, *by).agg(*aggs)


def bucket_state(readings: DataFrame, grain: str = "hour", keys: Sequence[str] = ()) -> DataFrame:
    """First and last reading of every bucket."""
    aggs = [F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")]
    for m in METERS:
        aggs.append(F.min_by(m, "ts").alias(f"first_{m}"))
        aggs.append(F.max_by(m, "ts").alias(f"last_{m}"))
    return _grouped(readings, F.col("ts"), grain, keys, aggs)


def roll_state(state: DataFrame, grain: str, keys: Sequence[str] = ()) -> DataFrame:
    """Merge hourly states into a coarser grain."""
    aggs = [F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")]
    for m in METERS:
        aggs.append(F.min_by(f"first_{m}", "first_ts").alias(f"first_{m}"))
        aggs.append(F.max_by(f"last_{m}", "last_ts").alias(f"last_{m}"))
    return _grouped(state, F.col("first_ts"), grain, keys, aggs)


def state_delta(
    state: DataFrame, grain: str, keys: Sequence[str] = (), mode: str = "within"
) -> DataFrame:
    """Consumption of every bucket from its state.

    ``mode="within"`` counts from the bucket's own first reading; ``"carry"`` counts from
    the last reading of the bucket before it, so that nothing between two
    buckets is lost. The order of buckets runs through one task per key: as many rows
    as the calendar has buckets.
    """
    if mode not in ("within", "carry"):
        raise ValueError(f"unknown mode {mode!r}")
    before = Window.partitionBy(*keys).orderBy("first_ts")

    def start(m: str) -> Column:
        first = F.col(f"first_{m}")
        if mode == "within":
            return first
        return F.coalesce(F.lag(f"last_{m}").over(before), first)

    deltas = [(F.col(f"last_{m}") - start(m)).cast(KW).alias(m) for m in METERS]
    dow = [cal.dow_sun0("first_ts").alias("dow")] if grain in WITH_DOW else []
    return state.select(*key_columns(grain, keys), *deltas, *dow)


def delta(
    readings: DataFrame, grain: str, keys: Sequence[str] = (), mode: str = "within"
) -> DataFrame:
    """Consumption per bucket straight from readings."""
    return state_delta(bucket_state(readings, grain, keys), grain, keys, mode)


def delta_by_window(readings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Hourly consumption with first/last window functions over one named frame.

    The window runs over the states of five-minute slices, twelve per hour at
    most, so an hour crowded with readings never lands in a window whole.
    """
    slices = (
        readings.groupBy(*keys, cal.floor_minutes("ts", 5).alias("slice"))
        .agg(
            *[F.min_by(m, "ts").alias(f"first_{m}") for m in METERS],
            *[F.max_by(m, "ts").alias(f"last_{m}") for m in METERS],
        )
        .withColumn("ts", cal.truncate("slice", "hour"))
    )
    frame = (
        Window.partitionBy(*keys, "ts")
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    deltas = [
        (F.last(f"last_{m}").over(frame) - F.first(f"first_{m}").over(frame)).cast(KW).alias(m)
        for m in METERS
    ]
    return slices.select(*keys, "ts", *deltas, cal.dow_sun0("ts").alias("dow")).distinct()


def period_ends(readings: DataFrame, grain: str, keys: Sequence[str] = ()) -> DataFrame:
    """The readings that open or close a period; ``edge`` tells which.

    A lone reading comes out once as each. The state of a period holds both
    readings whole, so one scan and one hash aggregation give them.
    """

    def reading(edge: str) -> Column:
        time = F.col(f"{edge}_ts")
        return F.struct(
            time.alias("ts"),
            *[F.col(f"{edge}_{m}").alias(m) for m in METERS],
            cal.time_band(f"{edge}_ts").alias("band"),
            cal.dow_sun0(f"{edge}_ts").alias("dow"),
            F.lit(edge).alias("edge"),
        )

    both = F.inline(F.array(reading("first"), reading("last")))
    return bucket_state(readings, grain, keys).select(*keys, both)


def drop_empty(agg: DataFrame) -> DataFrame:
    """Without buckets that miss a building, data-center or office value or have all three 0."""
    watched = [F.col(m) for m in ("building", "data_center", "office")]
    known = watched[0].isNotNull() & watched[1].isNotNull() & watched[2].isNotNull()
    moved = (watched[0] != 0) | (watched[1] != 0) | (watched[2] != 0)
    return agg.where(known & moved)


def in_order(agg: DataFrame, grain: str, keys: Sequence[str] = ()) -> DataFrame:
    """Globally sorted by bucket, for a sink or a report."""
    return agg.orderBy(*key_columns(grain, keys))


def first_rows(df: DataFrame, n: int, *by: str) -> DataFrame:
    return df.orderBy(*by).limit(n)


def in_year(df: DataFrame, year: int, column: str = "ts") -> DataFrame:
    """Rows of one year, as a time range that reaches the scan."""
    lo, hi = (F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
    return df.where((F.col(column) >= lo) & (F.col(column) < hi))
