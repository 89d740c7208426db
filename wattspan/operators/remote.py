"""Remote-working days: office load of the day band against a computed threshold.

``band_table`` is the (day, band) consumption table, day of week with Sunday 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions import calendar as cal
from wattspan.functions import energy
from wattspan.operators import merge

DAY_BAND = 2
HEADCOUNT = 57
ALWAYS_PRESENT = 10


def _weekend() -> Column:
    return F.col("dow").isin(0, 6)


def _usable(band_table: DataFrame) -> DataFrame:
    return band_table.where(F.col("office").isNotNull() & (F.col("office") != 0))


# Sums of one state and of many have the same type, so that means are the same numbers.
SUM, COUNT = "decimal(28,2)", "decimal(18,0)"
SUMS = ("weekend_sum", "weekend_n", "workday_sum", "workday_n")


def load_sums(band_table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sums and counts of the absolute office load in the day band, one row per key.

    Rows of months or loads add up to those of all their days.
    """
    sums = []
    for name, condition in (("weekend", _weekend()), ("workday", ~_weekend())):
        size = F.when(condition, F.abs("office"))
        sums += [F.sum(size).cast(SUM).alias(f"{name}_sum"), F.count(size).alias(f"{name}_n")]
    return _usable(band_table).where(F.col("band") == DAY_BAND).groupBy(*keys).agg(*sums)


def threshold_of(
    sums: DataFrame,
    headcount: int = HEADCOUNT,
    always_present: int = ALWAYS_PRESENT,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Load expected with only the always-present staff in, from any number of ``load_sums``."""
    added = sums.groupBy(*keys).agg(
        *[F.sum(c).cast(SUM if c.endswith("sum") else "bigint").alias(c) for c in SUMS]
    )
    means = added.select(
        *keys,
        *[
            (F.col(f"{n}_sum") / F.nullif(F.col(f"{n}_n").cast(COUNT), F.lit(0))).alias(f"{n}_mean")
            for n in ("weekend", "workday")
        ],
    )
    per_head = (F.col("workday_mean") - F.col("weekend_mean")) / F.lit(headcount)
    return means.withColumn(
        "threshold", F.col("weekend_mean") + per_head * F.lit(always_present)
    )


def remote_threshold(
    band_table: DataFrame,
    headcount: int = HEADCOUNT,
    always_present: int = ALWAYS_PRESENT,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Load expected with only the always-present staff in, one row per key.

    Weekend mean plus ``always_present`` times the per-head share of what
    workdays use on top. NULL when either mean is missing.
    """
    return threshold_of(load_sums(band_table, keys), headcount, always_present, keys)


def remote_flag(threshold: Column) -> Column:
    """KO above, OK below the threshold in the day band of a workday, else NA."""
    workday = (F.col("band") == DAY_BAND) & ~_weekend()
    return (
        F.when(workday & (F.col("office") > threshold), "KO")
        .when(workday & (F.col("office") < threshold), "OK")
        .otherwise("NA")
    )


def with_threshold(rows: DataFrame, threshold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``rows`` with the threshold of their key."""
    if keys:
        return rows.join(threshold.select(*keys, "threshold"), list(keys), "left")
    return rows.withColumn("threshold", threshold.select("threshold").scalar())


def flags_by(band_table: DataFrame, threshold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Flag of every usable (day, band) by a given threshold."""
    flag = remote_flag(F.col("threshold")).alias("remote_flag")
    return with_threshold(_usable(band_table), threshold, keys).select(*keys, "day", "band", flag)


def band_flags(band_table: DataFrame, keys: Sequence[str] = (), **params) -> DataFrame:
    """Flag of every usable (day, band)."""
    return flags_by(band_table, remote_threshold(band_table, keys=keys, **params), keys)


def month_states(band_table: DataFrame, threshold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What a month adds to the threshold, and how far this may move without changing its flags.

    One row per key and month (``day``, its first): ``load_sums``, the highest workday load at or
    below the threshold and the lowest at or above it.
    """
    rows = with_threshold(band_table, threshold, keys).withColumn("day", F.trunc("day", "month"))
    workday = (F.col("band") == DAY_BAND) & ~_weekend()
    near = _usable(rows).where(workday).groupBy(*keys, "day").agg(
        F.max(F.when(F.col("office") <= F.col("threshold"), F.col("office"))).alias("below"),
        F.min(F.when(F.col("office") >= F.col("threshold"), F.col("office"))).alias("above"),
        F.any_value("threshold").isNotNull().alias("judged"),
    )
    return load_sums(rows, [*keys, "day"]).join(near, [*keys, "day"], "left")


def months_to_flag(states: DataFrame, threshold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The months (``day``) whose flags another threshold changes.

    A month without workdays has no flag but NA; one that was not judged, for want of a
    threshold, has all to gain.
    """
    beside = with_threshold(states, threshold, keys).where("judged IS NOT NULL")
    stays = (
        F.col("judged")
        & (F.col("below").isNull() | (F.col("threshold") > F.col("below")))
        & (F.col("above").isNull() | (F.col("threshold") < F.col("above")))
    )
    without = ~F.col("judged") & F.col("threshold").isNull()
    return beside.where(~F.coalesce(stays | without, F.lit(False))).select("day").distinct()


def flag_bands(band_table: DataFrame, flags: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return merge.update_from(band_table, flags, [*keys, "day", "band"], ["remote_flag"])


def flag_days(day_table: DataFrame, flags: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The day table with the flag of each day's day band."""
    of_day = flags.where(F.col("band") == DAY_BAND).select(
        *keys, F.col("day").cast("timestamp_ntz").alias("ts"), "remote_flag"
    )
    return merge.update_from(day_table, of_day, [*keys, "ts"], ["remote_flag"])


def flag_counts(day_table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return day_table.groupBy(*keys, "remote_flag").agg(F.count(F.lit(1)).alias("days"))


def remote_share(day_table: DataFrame, grain: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of OK days among the flagged days of every month or year, as text."""
    period = cal.month_text("ts") if grain == "month" else F.year("ts")
    ok = F.count_if(F.col("remote_flag") == "OK")
    ko = F.count_if(F.col("remote_flag") == "KO")
    return (
        day_table.where(F.col("remote_flag").isin("OK", "KO"))
        .groupBy(*keys, period.alias("period"))
        .agg(energy.percent_text(ok, ok + ko).alias("remote_pct"))
    )


def flag_periods(
    table: DataFrame, day_table: DataFrame, grain: str, keys: Sequence[str] = ()
) -> DataFrame:
    """A month or year table with its share of remote days."""
    period = cal.month_text("ts") if grain == "month" else F.year("ts")
    with_period = table.withColumn("period", period)
    share = remote_share(day_table, grain, keys)
    return merge.update_from(with_period, share, [*keys, "period"], ["remote_pct"]).drop("period")
