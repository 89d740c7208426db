"""Linear meter ramps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.schema import KW

STEP_SECONDS = 300


def ramp_feed(
    bounds: DataFrame,
    first_value: Column,
    per_step: Column,
    origin: Column | None = None,
    step_seconds: int = STEP_SECONDS,
    keys: Sequence[str] = ("feed",),
) -> DataFrame:
    """A reading every ``step_seconds`` from ``start`` to ``end`` of each row of ``bounds``.

    The value is ``first_value`` at ``origin`` (default: the start) and grows by
    ``per_step`` for every 300 seconds. Unrolled by day, then within the day.
    """
    seconds = F.unix_timestamp(F.col("end").cast("timestamp")) - F.unix_timestamp(
        F.col("start").cast("timestamp")
    )
    per_day = 86400 // step_seconds
    steps = F.floor(seconds / step_seconds)
    start = F.unix_timestamp(F.col("start").cast("timestamp"))
    blocks = bounds.withColumn("_steps", steps).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_steps"), F.lit(per_day).cast("bigint")))
    )
    last = F.least(F.col("_steps"), F.col("_block") + per_day - 1)
    rows = blocks.withColumn("_i", F.explode(F.sequence(F.col("_block"), last)))
    at = start + F.col("_i") * step_seconds
    since = at - (F.unix_timestamp(origin.cast("timestamp")) if origin is not None else start)
    value = first_value + since / STEP_SECONDS * per_step
    return rows.select(
        *keys,
        F.timestamp_seconds(at).cast("timestamp_ntz").alias("ts"),
        value.cast(KW).alias("kilowatt"),
    )
