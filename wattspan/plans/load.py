"""The incremental load: feeds to readings, consumption tables, weather and flags.

Each hour's state is merged into the stored states, and every table comes from
those states, so the cost of a load follows its batch and the months it touches,
not the history. Each step reads what the step before it stored, which cuts the
lineage, and can be run again after a failure without changing the outcome.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.functions.calendar import GRAINS
from wattspan.operators import buckets, clean, merge, prep, readings, remote, sketches, weather as wx
from wattspan.plans.store import Store
from wattspan.schema import FEEDS, METERS
from wattspan.session import discard, shared_dir
from wattspan.sources import load_log, tables

# What becomes of a bucket that was open at an earlier load.
KEEP, RECOMPUTE = "keep", "recompute"


def _time(grain: str) -> str:
    return "day" if grain == "band" else "ts"


def _whole_years(span: tuple[int, int]) -> tuple[int, int]:
    return span[0] // 100 * 100 + 1, span[1] // 100 * 100 + 12


def _merge_states(
    spark: SparkSession, store: Store, batch: DataFrame, span, keys: Sequence[str]
) -> None:
    fresh = buckets.bucket_state(batch, "hour", keys)

    def change(stored: DataFrame | None) -> DataFrame:
        if stored is None:
            return fresh
        return buckets.roll_state(stored.unionByName(fresh), "hour", keys)

    tables.rewrite(spark, store.hour_state, span, change, keys=keys)


def _refresh(
    spark: SparkSession,
    store: Store,
    grain: str,
    span: tuple[int, int],
    weather: DataFrame | None,
    keys: Sequence[str],
    open_buckets: str,
) -> None:
    """Insert a grain's new buckets, drop empty ones, then merge the weather.

    A bucket once stored keeps its values, or takes those of all its readings so
    far. Weather comes after the empty buckets are gone, so hours that only have
    weather stay, with empty meters.
    """
    if grain == "year":
        span = _whole_years(span)
    states = tables.months(spark, store.hour_state, *span)
    fresh = buckets.state_delta(buckets.roll_state(states, grain, keys), grain, keys)

    def change(stored: DataFrame | None) -> DataFrame:
        by = buckets.key_columns(grain, keys)
        out = fresh
        if stored is not None:
            # A row that only has weather so far is not a stored bucket.
            held = buckets.drop_empty(stored)
            new = fresh if open_buckets == RECOMPUTE else merge.rows_to_insert(held, fresh, by)
            out = merge.upsert(stored, new, by, [c for c in fresh.columns if c not in by])
        out = buckets.drop_empty(out)
        if weather is None:
            return out
        # A range of the time itself, which reaches the scan of the weather.
        lo, hi = (F.lit(t).cast("timestamp_ntz") for t in tables.month_bounds(span))
        hours = weather.where((F.col("ts") >= lo) & (F.col("ts") < hi))
        return wx.merge_weather(out, hours, grain, keys)

    tables.rewrite(spark, store.agg(grain), span, change, _time(grain), keys)


def _classify(
    spark: SparkSession, store: Store, span: tuple[int, int], keys: Sequence[str], **params
) -> None:
    """Flag the (day, band) rows whose flags the load can have changed, in a narrow table.

    The threshold depends on all days, by sums that are kept per month. Days of the
    months that were loaded are flagged, and those of a month between whose loads the
    threshold has moved across one; other months of the consumption table are not read.
    """
    if not tables.exists(spark, store.agg("band")):
        return
    touched = tables.months(spark, store.agg("band"), *span)
    sums = remote.load_sums(touched, [*keys])
    also: list[int] = []
    if tables.exists(spark, store.threshold_state):
        month = tables.month_number("day")
        others = tables.read(spark, store.threshold_state).where(~month.between(*span))
        threshold = remote.threshold_of(
            others.select(*keys, *remote.SUMS).unionByName(sums), keys=keys, **params
        )
        # As many numbers as the calendar has months.
        moved = remote.months_to_flag(others, threshold, keys)
        also = [r[0] for r in moved.select(month).collect()]
    else:
        threshold = remote.threshold_of(sums, keys=keys, **params)
    bands = tables.months(spark, store.agg("band"), *span, also)
    flags = remote.flags_by(bands, threshold, keys)
    tables.rewrite(spark, store.flags, span, lambda _: flags, "day", keys, also)
    states = remote.month_states(bands, threshold, keys)
    tables.rewrite(spark, store.threshold_state, span, lambda _: states, "day", keys, also)


def _sketch(spark: SparkSession, store: Store, span: tuple[int, int]) -> None:
    """Sketch the hours of the months the load touched; those of other months stay."""
    if not tables.exists(spark, store.agg("hour")):
        return
    hours = tables.months(spark, store.agg("hour"), *span)
    fresh = sketches.month_sketches(hours, METERS)
    tables.rewrite(spark, store.sketches("hour"), span, lambda _: fresh)


def _hints(spark: SparkSession, store: Store) -> DataFrame | None:
    path = store.sketches("hour")
    return tables.read(spark, path) if tables.exists(spark, path) else None


def usual_hours(spark: SparkSession, store: Store, column: str, threshold: float) -> DataFrame:
    """Stored hours without the outliers of a meter, by all stored hours.

    The kept sketches say where the limits lie, so the history is passed over twice for
    them, one column wide.
    """
    hours = tables.read(spark, store.agg("hour"))
    return prep.filter_outliers(hours, column, threshold, sketches=_hints(spark, store))


def summary(spark: SparkSession, store: Store, columns: Sequence[str] = METERS) -> DataFrame:
    """Summary statistics of the stored hours, quartiles from the kept sketches on."""
    return prep.describe(tables.read(spark, store.agg("hour")), columns, _hints(spark, store))


def classified(
    spark: SparkSession, store: Store, grain: str, keys: Sequence[str] = ()
) -> DataFrame:
    """A stored table with its remote-working flag, or its share of remote days."""
    table = tables.read(spark, store.agg(grain))
    if grain == "hour":
        return table
    flags = tables.read(spark, store.flags)
    if grain == "band":
        return remote.flag_bands(table, flags, keys)
    if grain == "day":
        return remote.flag_days(table, flags, keys)
    days = remote.flag_days(tables.read(spark, store.agg("day")), flags, keys)
    return remote.flag_periods(table, days, grain, keys)


def load(
    raw: DataFrame,
    store: Store,
    weather: DataFrame | None = None,
    keys: Sequence[str] = (),
    downloaded_at: Column | None = None,
    open_buckets: str = KEEP,
    **remote_params,
) -> bool:
    """Load what ``raw`` has beyond the last load; False when there is nothing new.

    ``raw`` holds (feed, seq, ts, kilowatt) and any ``keys``; ``weather`` the
    hourly weather of at least the months the new rows touch. With ``keys`` every
    group has its own last load. ``open_buckets`` says whether a bucket that an
    earlier load left open keeps its values or is computed again.
    """
    if open_buckets not in (KEEP, RECOMPUTE):
        raise ValueError(f"unknown open_buckets {open_buckets!r}")
    spark = raw.sparkSession
    log = None
    if tables.exists(spark, store.load_log):
        fields = [raw.schema[k] for k in keys]
        log = load_log.read_log(spark, store.load_log, fields)

    def beyond(rows: DataFrame) -> DataFrame:
        return rows if log is None else clean.new_rows(rows, log, keys)

    # One pass over the raw rows beyond the last load, and one shuffle of them, drops
    # duplicates and brings the feeds side by side; all else reads its result.
    staged = shared_dir(spark, "side_by_side")
    try:
        arrived = readings.side_by_side(beyond(raw.where("ts IS NOT NULL")), keys, order="seq")
        if not tables.store_new(arrived, staged, [*keys, "ts"]):
            return False
        wide = _aligned(spark, store, tables.read(spark, staged), keys, log is not None)
        times = tables.time_span(wide)
        if times is None:
            return False
        _load_staged(spark, store, wide, times, weather, keys, open_buckets, beyond, downloaded_at,
                     remote_params)
    finally:
        discard(spark, staged)
    return True


def _aligned(
    spark: SparkSession, store: Store, wide: DataFrame, keys: Sequence[str], loaded: bool
) -> DataFrame:
    """Rows up to the last time every feed has reached, those without new rows included.

    The last time of every feed and key is kept, so that the history is not read for it.
    """
    ends = clean.feed_ends(wide, FEEDS, keys)
    if tables.exists(spark, store.feed_ends):
        ends = ends.unionByName(tables.read_parts(spark, store.feed_ends))
    elif loaded and tables.exists(spark, store.feeds):  # a store from before they were kept
        held = tables.read(spark, store.feeds).groupBy(*keys, "feed").agg(F.max("ts").alias("end"))
        ends = ends.unionByName(held)
    ends = ends.groupBy(*keys, "feed").agg(F.max("end").alias("end"))
    tables.put_rows(ends, store.feed_ends, "ends")
    return clean.up_to_horizon(wide, tables.read_parts(spark, store.feed_ends), keys)


def _load_staged(
    spark, store, wide, times, weather, keys, open_buckets, beyond, downloaded_at, remote_params
) -> None:
    by, span = [*keys, "ts"], tables.month_span(times)
    for rows, path, unique in (
        (readings.feed_rows(wide, keys), store.feeds, [*keys, "feed", "ts"]),
        (readings.office_of(wide, keys), store.office, by),
        (readings.readings_of(wide, keys), store.readings, by),
    ):
        tables.append_new(rows, path, unique, gather=False, times=times)
        tables.compact(spark, path, keys=keys)
    if tables.exists(spark, store.readings):
        batch = beyond(tables.months(spark, store.readings, *span))
        if not batch.isEmpty():
            _merge_states(spark, store, batch, span, keys)
            for grain in GRAINS:
                _refresh(spark, store, grain, span, weather, keys, open_buckets)
            _sketch(spark, store, span)
            _classify(spark, store, span, keys, **remote_params)
    load_log.append_log(load_log.log_entry(wide, downloaded_at, keys), store.load_log)
