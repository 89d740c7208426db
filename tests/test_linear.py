from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.operators import linear


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1000, [1, 5, 0.1], (300, 3))
    y = x @ [2.0, -3.0, 40.0] + 7 + rng.normal(0, 0.5, 300)
    data = [(i % 4, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    data += [(0, None, 1.0, 1.0, 1.0), (1, 1.0, 1.0, 1.0, None), (2, float("nan"), 1.0, 1.0, 1.0)]
    return spark.createDataFrame(data, "month int, a double, b double, c double, y double").repartition(5), x, y


INPUTS = ["a", "b", "c"]


def least_squares(x, y):
    return np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]


def test_states_merge_into_the_state_of_all_rows(rows):
    df, x, y = rows
    whole = linear.state(df, INPUTS, "y").first()
    months = linear.merged(linear.state(df, INPUTS, "y", ["month"]), 4).first()
    assert whole["n"] == months["n"] == 300
    assert months["means"] == pytest.approx(whole["means"], rel=1e-12)
    assert months["moments"] == pytest.approx(whole["moments"], rel=1e-9, abs=1e-6)


def test_least_squares(rows):
    df, x, y = rows
    want = least_squares(x, y)
    fit = linear.fit(linear.state(df, INPUTS, "y")).first()["fit"]
    assert fit["weights"] == pytest.approx(want[:3], rel=1e-6)
    assert fit["intercept"] == pytest.approx(want[3], rel=1e-6)


def test_every_key_has_its_own_model(rows):
    df, x, y = rows
    fits = linear.fit(linear.state(df, INPUTS, "y", ["month"]))
    assert fits.count() == 4
    scored = linear.predict(df, fits, INPUTS, ["month"])
    second = scored.where("month = 1 AND y IS NOT NULL").orderBy("a").collect()
    part = slice(1, None, 4)
    want = least_squares(x[part], y[part])
    order = np.argsort(x[part][:, 0])
    values = np.column_stack([x[part], np.ones(75)]) @ want
    assert [r["prediction"] for r in second] == pytest.approx(values[order], rel=1e-9)
    assert scored.where("a IS NULL").first()["prediction"] is None


def test_inputs_that_depend_on_each_other(spark):
    df = spark.createDataFrame(
        [(float(i), 2.0 * i, 5.0, 3.0 * i + 1) for i in range(10)], "a double, b double, c double, y double"
    )
    fit = linear.fit(linear.state(df, INPUTS, "y"))
    scored = linear.predict(df, fit, INPUTS).collect()
    assert [r["prediction"] for r in scored] == pytest.approx([r["y"] for r in scored])


@pytest.mark.parametrize("strength", [0.1, 1.0, 1e6])
def test_lasso_reaches_its_minimum(rows, strength):
    df, x, y = rows
    fit = linear.fit(linear.state(df, INPUTS, "y"), strength).first()["fit"]
    w = np.array(fit["weights"])
    centred, rest = x - x.mean(axis=0), y - y.mean()
    slope = centred.T @ (rest - centred @ w) / len(y)
    # At the minimum the slope of the error equals the strength where a weight is not zero.
    for s, v in zip(slope, w):
        assert (abs(s) <= strength * (1 + 1e-6)) if v == 0 else s == pytest.approx(np.sign(v) * strength, rel=1e-4)
    assert fit["intercept"] == pytest.approx(y.mean() - x.mean(axis=0) @ w)
    if strength == 1e6:
        assert not w.any()


def test_values_of_other_folds(spark, rows):
    df, x, y = rows
    known = df.where("y IS NOT NULL AND a IS NOT NULL AND NOT isnan(a)")
    held = linear.out_of_fold(known, {"base": ["a"], "all": INPUTS}, "y", 4, "month").where("month = 2").orderBy("a").collect()
    out = np.arange(300) % 4 != 2
    want = np.column_stack([x[~out], np.ones(75)]) @ least_squares(x[out], y[out])
    order = np.argsort(x[~out][:, 0])
    assert [r["all"] for r in held] == pytest.approx(want[order], rel=1e-9)
    slope, start = np.polyfit(x[out][:, 0], y[out], 1)
    assert [r["base"] for r in held] == pytest.approx((slope * x[~out][:, 0] + start)[order], rel=1e-6)


def test_no_rows(spark, rows):
    none = rows[0].where("false")
    fit = linear.fit(linear.merged(linear.state(none, INPUTS, "y", ["month"]), 4))
    assert fit.count() == 0
    assert linear.predict(rows[0].limit(3), fit, INPUTS).where("prediction IS NOT NULL").isEmpty()


def test_one_scan_and_one_shuffle_for_a_state(rows):
    plan = linear.state(rows[0], INPUTS, "y")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    assert plan.count("HashAggregate") <= 2
