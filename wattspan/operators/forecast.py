"""Scoring of future weather and its rollup to day bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions import calendar as cal
from wattspan.functions import comfort
from wattspan.operators import model as ml
from wattspan.operators import prep
from wattspan.operators.ensemble import Stack
from wattspan.schema import CALENDAR_FEATURES, SCALED_FEATURES

FORECAST = "building_forecast"


def future_rows(
    weather: DataFrame, wind_factor: float = comfort.WIND_TO_MPH, keys: Sequence[str] = ()
) -> DataFrame:
    """Feature rows of hourly weather that has no consumption yet."""
    full = prep.with_calendar(
        weather.withColumns(comfort.weather_indices(wind_factor=wind_factor))
    ).withColumn("band", cal.time_band("ts"))
    return full.select(
        *keys, "ts", *[F.col(c).cast("double").alias(c) for c in SCALED_FEATURES], *CALENDAR_FEATURES
    )


def score(model: PipelineModel | Stack, rows: DataFrame, refit_scaler: bool = False) -> DataFrame:
    """Rows with their prediction.

    ``refit_scaler`` scales by the batch's own statistics instead of the
    training statistics.
    """
    if isinstance(model, Stack):
        return model.score(rows, refit_scaler).select(*rows.columns, "prediction")
    if refit_scaler:
        model = PipelineModel([ml.fit_scaler(rows), *model.stages[1:]])
    return model.transform(rows).select(*rows.columns, "prediction")


def band_rollup(
    rows: DataFrame, prediction: str | None = "prediction", keys: Sequence[str] = ()
) -> DataFrame:
    """Feature means, and the summed prediction, per key, day and band."""
    total = [F.sum(prediction).alias(FORECAST)] if prediction else []
    grouped = rows.groupBy(*keys, "year", "month", "day", "dow", "band").agg(
        *[F.avg(c).alias(c) for c in SCALED_FEATURES], *total
    )
    return grouped.withColumn("day", F.make_date("year", "month", "day")).select(
        *keys, "day", "dow", "band", *SCALED_FEATURES, *([FORECAST] if prediction else [])
    )


def forecast_bands(
    model: PipelineModel | Stack,
    weather: DataFrame,
    updated_at: Column | None = None,
    refit_scaler: bool = False,
    wind_factor: float = comfort.WIND_TO_MPH,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Forecast table rows for hourly future weather, of each key's own if there are any."""
    scored = score(model, future_rows(weather, wind_factor, keys), refit_scaler)
    return rolled_up(scored, updated_at, keys)


def rolled_up(
    scored: DataFrame, updated_at: Column | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Forecast table rows of scored hours, with the time they were made."""
    stamp = F.current_timestamp() if updated_at is None else updated_at
    return band_rollup(scored, keys=keys).withColumn("updated_at", stamp.cast("timestamp_ntz"))
