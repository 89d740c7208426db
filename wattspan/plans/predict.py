"""Training on the stored hourly table and forecasting from future weather."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.operators import forecast as fc
from wattspan.operators import ensemble, model, prep
from wattspan.operators import weather as wx
from wattspan.plans.store import Store
from wattspan.session import shared_dir
from wattspan.sources import tables


def train(
    spark: SparkSession,
    store: Store,
    forest_grid: Mapping[str, Sequence] = ensemble.FOREST_GRID,
    boosted_grid: Mapping[str, Sequence] = ensemble.BOOSTED_GRID,
    folds: int = 5,
    search_folds: int = 3,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Tune, stack and save the load model; returns its errors on held-out rows.

    With ``keys`` one model learns from the rows of all of them. The model becomes the
    current one once it is written whole; until then the one before it is used.
    """
    path = shared_dir(spark, "features")
    hours = tables.read(spark, store.agg("hour"))
    prep.feature_rows(hours, keys=keys).write.parquet(path)
    rows = model.with_label(spark.read.parquet(path))
    row = (*keys, "ts")
    training, held_out = model.split(rows, keys=row)
    stack, _ = ensemble.fit(training, forest_grid, boosted_grid, folds, search_folds, row)
    ensemble.save(spark, stack, store.model)
    names = {"forest": "forest", "boosted": "boosted", "stack": "prediction"}
    return model.evaluate(stack.score(held_out), names)


def forecast(
    spark: SparkSession,
    store: Store,
    weather: DataFrame,
    as_of: Column | None = None,
    days: int = 14,
    refit_scaler: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Forecast the day of ``as_of`` and the days after it; add it to the forecast table.

    The forecasts of a day are one part of the table: a run that is repeated replaces its
    own rows, and no others.
    """
    now = F.current_timestamp() if as_of is None else as_of
    rows = fc.forecast_bands(
        ensemble.load(spark, store.model), wx.forecast_window(weather, now, days), now, refit_scaler, keys=keys
    )
    run = spark.range(1).select(F.to_date(now).cast("string")).first()[0]
    tables.put_rows(rows, store.forecasts, run)
    return spark.read.parquet(tables.parts(spark, store.forecasts)[run])
