"""Regression error measures as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def error_metrics(
    df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()
) -> DataFrame:
    """MAE, MSE, RMSE and R² in one pass; decimal inputs are summed exactly."""
    known = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    err = F.col(actual) - F.col(predicted)
    y = F.col(actual).cast("double")
    sums = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(F.abs(err)).cast("double") / F.count(F.lit(1))).alias("mae"),
        (F.sum(err * err).cast("double") / F.count(F.lit(1))).alias("mse"),
        F.var_pop(y).alias("_spread"),
    )
    return sums.select(
        *keys,
        "n",
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide(F.col("mse"), F.col("_spread"))).alias("r2"),
    )


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line through (x, y), as an aggregate."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_count(yd, xd).alias("n"),
        F.regr_slope(yd, xd).alias("slope"),
        F.regr_intercept(yd, xd).alias("intercept"),
    )
