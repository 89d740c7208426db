"""Linear and lasso regression from a state that merges.

The state of a set of rows is their number, the mean of every column and the
co-moments of every pair of columns about these means: (p + 1)^2 numbers for p
inputs, in one aggregation with partial sums. States of folds, months or loads
merge into the state of all their rows, so a model over history never reads the
history again, and leaving a fold out merges the others. A model is solved from
one state, whatever number of rows it stands for; with ``keys`` every group has a
state and a model of its own, solved where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

STATE = ("n", "means", "moments")
FIT = "struct<intercept: double, weights: array<double>>"
# Coordinate descent ends once no weight moves by more, or after so many rounds.
STILL, ROUNDS = 1e-12, 100_000


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i, n)]


def state(rows: DataFrame, inputs: Sequence[str], label: str, keys: Sequence[str] = ()) -> DataFrame:
    """The state of every key's complete rows: ``n``, ``means`` and ``moments``.

    The label is the last column; moments hold the pairs (i, j), i <= j, row by row.
    """
    z = [F.col(c).cast("double") for c in (*inputs, label)]
    known = rows.where(F.forall(F.array(*z), lambda x: x.isNotNull() & ~F.isnan(x)))
    return known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in z]).alias("means"),
        F.array(*[F.covar_pop(z[i], z[j]) * F.count(F.lit(1)) for i, j in _pairs(len(z))]).alias("moments"),
    )


def merged(states: DataFrame, columns: int, keys: Sequence[str] = ()) -> DataFrame:
    """One state per key for all rows that its states stand for; ``columns`` counts the label."""
    some = states.where("n > 0")
    n, at = F.col("n").cast("double"), [F.col("means")[i] for i in range(columns)]
    centre = some.groupBy(*keys).agg(
        F.sum("n").alias("_all"),
        F.array(*[F.sum(n * m) / F.sum(n) for m in at]).alias("_centre"),
    )
    if keys:
        # One row a key, whose size decides how it is joined.
        beside = some.join(centre, list(keys))
    else:
        beside = some.withColumn("_one", centre.select(F.struct("_all", "_centre")).scalar()).select(
            "*", "_one._all", "_one._centre"
        )
    off = [m - F.col("_centre")[i] for i, m in enumerate(at)]
    return beside.groupBy(*keys).agg(
        F.any_value("_all").alias("n"),
        F.any_value("_centre").alias("means"),
        F.array(
            *[
                F.sum(F.col("moments")[k] + n * off[i] * off[j])
                for k, (i, j) in enumerate(_pairs(columns))
            ]
        ).alias("moments"),
    ).where("n > 0")


def solve(n: float, means: np.ndarray, moments: np.ndarray, strength: float) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise half the mean squared error plus ``strength`` times
    the sum of the weights' sizes. Inputs that depend on each other share their weight."""
    p = len(means) - 1
    full = np.zeros((p + 1, p + 1))
    rows, columns = np.triu_indices(p + 1)
    full[rows, columns] = full[columns, rows] = moments
    a, b = full[:p, :p] / n, full[:p, p] / n
    # In units of the inputs' deviations, so that sizes do not decide what counts as singular.
    unit = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    if not strength:
        weights = np.linalg.pinv(a / np.outer(unit, unit), rcond=1e-12, hermitian=True) @ (b / unit) / unit
    else:
        weights = np.zeros(p)
        for _ in range(ROUNDS):
            moved = 0.0
            for i in range(p):
                if a[i, i] <= 0:
                    continue
                rest = b[i] - a[i] @ weights + a[i, i] * weights[i]
                new = np.sign(rest) * max(abs(rest) - strength, 0.0) / a[i, i]
                moved = max(moved, abs(new - weights[i]) * unit[i])
                weights[i] = new
            if moved <= STILL * max(1.0, np.sqrt(full[p, p] / n)):
                break
    return float(means[p] - means[:p] @ weights), weights


def fit(states: DataFrame, strength: float = 0.0) -> DataFrame:
    """States with the ``fit`` (intercept, weights) of each: least squares, or a lasso."""

    @F.pandas_udf(FIT)
    def solved(n: pd.Series, means: pd.Series, moments: pd.Series) -> pd.DataFrame:
        found = [solve(float(c), np.asarray(m, float), np.asarray(s, float), strength)
                 for c, m, s in zip(n, means, moments)]
        return pd.DataFrame({
            "intercept": [i for i, _ in found], "weights": [w.tolist() for _, w in found]
        })

    return states.withColumn("fit", solved(*STATE))


def value(inputs: Sequence[str], fitted: str = "_fit") -> Column:
    """The value a fit gives a row; null if an input is."""
    out = F.col(f"{fitted}.intercept")
    for i, c in enumerate(inputs):
        out = out + F.col(f"{fitted}.weights")[i] * F.col(c).cast("double")
    return out


def predict(
    rows: DataFrame, fitted: DataFrame, inputs: Sequence[str], keys: Sequence[str] = (),
    output: str = "prediction",
) -> DataFrame:
    """``rows`` with the prediction of their key's fit; null for a key without one."""
    if keys:
        held = rows.join(fitted.select(*keys, F.col("fit").alias("_fit")), list(keys), "left")
    else:
        held = rows.withColumn("_fit", fitted.select("fit").scalar())
    return held.withColumn(output, value(inputs)).drop("_fit")


def left_out(states: DataFrame, columns: int, folds: int, fold: str = "_fold") -> DataFrame:
    """For every fold the state of all other folds' rows."""
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda k: k != F.col(fold))
    spread = states.withColumn("_left", F.explode(others)).drop(fold)
    return merged(spread.withColumnRenamed("_left", fold), columns, [fold])


def out_of_fold(
    rows: DataFrame, bases: dict[str, Sequence[str]], label: str, folds: int, fold: str = "_fold"
) -> DataFrame:
    """``rows`` with a column per base: its value by the fit on all folds but the row's own.

    ``bases`` maps a column name to the inputs of its linear model. Every fold is read once,
    for its state.
    """
    out = rows
    for name, inputs in bases.items():
        states = state(rows, inputs, label, [fold])
        fits = fit(left_out(states, len(inputs) + 1, folds, fold))
        out = predict(out, fits, inputs, [fold], name)
    return out
