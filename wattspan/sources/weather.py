"""Decoding of weather-service responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspan.functions.calendar import from_epoch
from wattspan.schema import WEATHER_VARS


def explode_weather(responses: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per hour from responses holding one array per variable.

    ``start``, ``end`` and ``step`` are epoch seconds and seconds; the time axis
    runs from start to end, end excluded.
    """
    axis = F.transform(
        F.sequence(F.col("start"), F.col("end") - F.col("step"), F.col("step")), from_epoch
    )
    zipped = F.arrays_zip(axis.alias("ts"), *[F.col(v) for v in WEATHER_VARS])
    return responses.select(*keys, F.explode(zipped).alias("_h")).select(
        *keys, F.col("_h")["ts"].alias("ts"), *[F.col("_h")[v].alias(v) for v in WEATHER_VARS]
    )
