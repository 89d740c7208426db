"""Joining the meter feeds into one row per time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wattspan.functions import calendar as cal
from wattspan.functions import energy
from wattspan.schema import FEEDS, KW


def side_by_side(
    feeds: DataFrame, keys: Sequence[str] = (), order: str | None = None
) -> DataFrame:
    """The long feed table as one row per time, with a presence flag per feed.

    This is the full outer join of the feeds on their time, written as one
    aggregation: one scan and one shuffle instead of three of each. Feeds hold
    one row per time (``clean.dedup_feed``), unless ``order`` names the number
    by which the first of several is taken, which drops duplicates in the same
    shuffle.
    """

    def of(feed: str, column: str):
        return F.when(F.col("feed") == feed, F.col(column))

    if order is None:
        values = [F.max(of(f, "kilowatt")).alias(f) for f in FEEDS]
    else:
        values = [F.min_by(of(f, "kilowatt"), of(f, order)).alias(f) for f in FEEDS]
    present = [F.max(F.col("feed") == f).alias(f"has_{f}") for f in FEEDS]
    return feeds.where(F.col("feed").isin(*FEEDS)).groupBy(*keys, "ts").agg(*values, *present)


def feed_rows(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The long feed table from its side-by-side form."""
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("feed"),
                F.col(f).alias("kilowatt"),
                F.col(f"has_{f}").alias("present"),
            )
            for f in FEEDS
        ]
    )
    rows = wide.select(*keys, "ts", F.inline(entries)).where("present")
    return rows.select("feed", *keys, "ts", "kilowatt")


def office_load(feeds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Office load at every time any feed has, missing feeds counting as 0."""
    return office_of(side_by_side(feeds, keys), keys)


def office_of(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return wide.select(*keys, "ts", energy.office(*FEEDS).alias("kilowatt"))


def join_readings(
    feeds: DataFrame, keys: Sequence[str] = (), solar_missing: str = "zero"
) -> DataFrame:
    """Readings at every time both the building and the data-center feed have.

    ``solar_missing="zero"`` counts a missing solar reading as 0, as the stored
    tables do; ``"null"`` leaves the solar column empty.
    """
    return readings_of(side_by_side(feeds, keys), keys, solar_missing)


def readings_of(
    wide: DataFrame, keys: Sequence[str] = (), solar_missing: str = "zero"
) -> DataFrame:
    if solar_missing not in ("zero", "null"):
        raise ValueError(f"unknown solar_missing {solar_missing!r}")
    solar = energy.zero_if_missing("solar") if solar_missing == "zero" else F.col("solar").cast(KW)
    return wide.where("has_building AND has_data_center").select(
        *keys,
        "ts",
        energy.zero_if_missing("building").alias("building"),
        energy.zero_if_missing("data_center").alias("data_center"),
        solar.alias("solar"),
        energy.office(*FEEDS).alias("office"),
        cal.time_band("ts").alias("band"),
        cal.dow_sun0("ts").alias("dow"),
    )
