"""Weather resampling and its merge into the consumption tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions import calendar as cal
from wattspan.operators import merge
from wattspan.schema import KW, WEATHER_VARS

STEPS = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH",
         "year": "INTERVAL 1 YEAR"}


def _means() -> list[Column]:
    return [F.avg(v).alias(v) for v in WEATHER_VARS]


def spine(times: DataFrame, grain: str, keys: Sequence[str] = ()) -> DataFrame:
    """Every bucket between the first and the last time, gaps included.

    Unrolled a year at a time, so that the buckets spread over rows before the
    finest steps are generated.
    """
    bounds = times.groupBy(*keys).agg(
        cal.truncate(F.min("ts"), grain).alias("_lo"), cal.truncate(F.max("ts"), grain).alias("_hi")
    )
    years = F.sequence(cal.truncate("_lo", "year"), F.col("_hi"), F.expr(STEPS["year"]))
    by_year = bounds.where(F.col("_lo").isNotNull()).select(
        *keys, "_lo", "_hi", F.explode(years).alias("_year")
    )
    last = F.least(
        F.col("_hi"), F.col("_year") + F.expr("INTERVAL 1 YEAR") - F.expr("INTERVAL 1 HOUR")
    )
    steps = F.sequence(F.greatest("_lo", "_year"), last, F.expr(STEPS[grain]))
    return by_year.select(*keys, F.explode(steps).alias("ts"))


def resample(weather: DataFrame, grain: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of every variable per bucket; buckets without weather stay, with NULLs.

    The hourly table also carries the band of its hour.
    """
    aggs = _means()
    if grain == "hour":
        aggs.insert(0, F.max(cal.time_band("ts")).alias("band"))
    means = weather.groupBy(*keys, cal.truncate("ts", grain).alias("ts")).agg(*aggs)
    # The bounds come from the means, so the weather itself is read once.
    return spine(means.select(*keys, "ts"), grain, keys).join(means, [*keys, "ts"], "left")


def band_weather(weather: DataFrame, how: str = "last", keys: Sequence[str] = ()) -> DataFrame:
    """Weather per (day, band): of its last hour, or the mean of all its hours."""
    by = [*keys, F.to_date("ts").alias("day"), cal.time_band("ts").alias("band")]
    if how == "mean":
        return weather.groupBy(*by).agg(*_means())
    if how != "last":
        raise ValueError(f"unknown how {how!r}")
    at_time = weather.groupBy(*keys, "ts").agg(*_means())
    return at_time.groupBy(*by).agg(*[F.max_by(v, "ts").alias(v) for v in WEATHER_VARS])


def as_stored(df: DataFrame) -> DataFrame:
    """Weather columns as the tables keep them: two decimals, NaN as NULL."""
    have = set(df.columns)
    return df.withColumns(
        {
            v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v)).cast(KW)
            for v in WEATHER_VARS
            if v in have
        }
    )


def merge_weather(
    agg: DataFrame, weather: DataFrame, grain: str, keys: Sequence[str] = (), how: str = "last"
) -> DataFrame:
    """A consumption table with its weather columns overwritten by resampled weather.

    Keys only the weather has are added with empty meters.
    """
    if grain == "band":
        by = [*keys, "day", "band"]
        source = band_weather(weather, how, keys)
        columns = list(WEATHER_VARS)
    else:
        by = [*keys, "ts"]
        source = resample(weather, grain, keys)
        columns = [*(["band"] if grain == "hour" else []), *WEATHER_VARS]
    return merge.upsert(agg, as_stored(source), by, columns)


def weather_between(weather: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """Hours from the start of ``first_day`` to the end of ``last_day``."""
    return weather.where(
        (F.col("ts") >= first_day.cast("timestamp_ntz"))
        & (F.col("ts") < F.date_add(last_day, 1).cast("timestamp_ntz"))
    )


def archive_window(weather: DataFrame, start: Column, end: Column) -> DataFrame:
    return weather_between(weather, F.to_date(start), F.to_date(end))


def forecast_window(weather: DataFrame, as_of: Column, days: int = 14) -> DataFrame:
    """The day of ``as_of`` and the ``days`` after it."""
    first = F.to_date(as_of)
    return weather_between(weather, first, F.date_add(first, days))
