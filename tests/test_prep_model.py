from __future__ import annotations

import math
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattspan.operators import forecast, metrics, model, prep, sketches
from wattspan.schema import FEATURES, SCALED_FEATURES, WEATHER_VARS


@pytest.fixture
def numbers(spark):
    def make(values, name="x"):
        data = [(i, None if v is None else Decimal(str(v))) for i, v in enumerate(values)]
        return spark.createDataFrame(data, f"id int, {name} decimal(10,2)")

    return make


@pytest.mark.parametrize("size", [1, 2, 7, 500])
def test_quantiles_are_exact(numbers, size):
    rng = random.Random(size)
    # Values on both sides of zero, many cells apart, with heavy ties.
    values = [round(rng.choice([rng.uniform(-9e6, 9e6), 12.5, -0.01]), 2) for _ in range(size)]
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r["prob"]: r["value"] for r in prep.quantiles(numbers(values + [None]), ["x"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(pd.Series(values).quantile(p), rel=1e-12, abs=1e-9)


def test_quantiles_of_any_number(spark):
    rng = random.Random(3)
    values = [rng.lognormvariate(0, 6) for _ in range(300)] + [1e-300, 1e12]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, v double")
    got = {(r["name"], r["prob"]): r["value"] for r in prep.quantiles(df, ["n", "v"], [0.1, 0.5]).collect()}
    for p in (0.1, 0.5):
        assert got["v", p] == pytest.approx(pd.Series(values).quantile(p), rel=1e-12)
        assert got["n", p] == pytest.approx(pd.Series(range(302)).quantile(p))


@pytest.fixture(scope="module")
def tied(spark, tmp_path_factory):
    """Two months of values with a third equal, on disk, and their sketches."""
    rng = random.Random(5)
    values = [round(rng.lognormvariate(2, 2), 2) for _ in range(4000)] + [12.5] * 2000
    rows = pd.DataFrame({"i": range(len(values)), "x": values, "none": [None] * len(values)})
    df = spark.createDataFrame(rows, "i int, x double, none double").withColumn(
        "ts", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(i % 60)")
    )
    folder = str(tmp_path_factory.mktemp("tied"))
    df.write.parquet(f"{folder}/rows")
    df = spark.read.parquet(f"{folder}/rows")
    # Small sketches, so that their answers are not exact.
    sketches.month_sketches(df, ["x", "i", "none"], size=64).write.parquet(f"{folder}/sketches")
    return values, df, spark.read.parquet(f"{folder}/sketches")


@pytest.mark.parametrize("known", ["true", "ts < '2024-02-01'", "name = 'i'", "false", "shifted"])
def test_quantiles_by_sketches_are_exact_whatever_the_sketches(tied, known):
    values, df, kept = tied
    if known == "shifted":  # sketches of other values: every rank lies below or above
        kept = sketches.month_sketches(df.withColumn("x", F.col("x") + 1e6).withColumn("i", -F.col("i")), ["x", "i"])
    else:
        kept = kept.where(known)
    probs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    found = prep.quantiles(df, ["x", "i", "none"], probs, kept).collect()
    got = {(r["name"], r["prob"]): r["value"] for r in found}
    assert len(got) == len(found) == 2 * len(probs)
    for p in probs:
        assert got["x", p] == pytest.approx(pd.Series(values).quantile(p), rel=1e-12, abs=1e-9)
        assert got["i", p] == pytest.approx(pd.Series(range(len(values))).quantile(p))


def test_values_far_from_the_ranks_are_not_grouped(tied):
    _, df, _ = tied
    kept = sketches.month_sketches(df, ["i"])
    _, counts = prep._hinted(df, ["i"], [0.5], kept)
    assert 0 < counts.count() <= 2 * 2 * sketches.MARGIN * 6000


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz, x double")
    kept = sketches.month_sketches(df, ["x"])
    assert kept.count() == 0
    assert prep.quantiles(df, ["x"], [0.5], kept).count() == 0
    assert prep.filter_outliers(df, "x", 0.95, sketches=kept).count() == 0


def test_filter_outliers(numbers):
    values = list(range(100))
    kept = [r["x"] for r in prep.filter_outliers(numbers(values), "x", 0.95).collect()]
    s = pd.Series(values)
    want = s[(s <= s.quantile(0.95)) & (s >= s.quantile(1 - 0.95))]
    assert sorted(map(int, kept)) == list(want)


def test_filter_outliers_approximately(numbers):
    kept = prep.filter_outliers(numbers(list(range(1000))), "x", 0.95, accuracy=10_000).count()
    assert abs(kept - 900) <= 4


def test_describe_matches_pandas(numbers):
    values = [1.5, 2.25, -7, 100, 3]
    row = prep.describe(numbers(values), ["x"]).first()
    want = pd.Series(values).describe()
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                         ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert row[ours] == pytest.approx(want[theirs])


def test_fill_zero(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) AS a, CAST(NULL AS DECIMAL(10,2)) AS b, CAST(NULL AS STRING) AS c")
    assert tuple(prep.fill_zero(df).first()) == (0, 0, None)


@pytest.fixture
def hours(spark):
    """Hourly table of 20 days whose building load follows temperature and hour."""
    rng = random.Random(3)
    rows = []
    for i in range(20 * 24):
        ts = pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)
        w = [rng.uniform(0, 40) for _ in WEATHER_VARS]
        building = 5 * w[0] + 10 * ts.hour + rng.uniform(-1, 1)
        rows.append((ts.to_pydatetime(), round(building, 2), 1.0, 0.0 if i % 8 == 0 else 2.0, 3.0,
                     (ts.weekday() + 1) % 7, 1 if ts.hour < 9 else 2 if ts.hour < 19 else 3, *w))
    cols = ["ts", "building", "data_center", "solar", "office", "dow", "band", *WEATHER_VARS]
    pdf = pd.DataFrame(rows, columns=cols)
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return df.withColumns({c: F.col(c).cast("decimal(10,2)") for c in cols if c not in ("ts", "dow", "band")}
                          ).withColumns({c: F.col(c).cast("int") for c in ("dow", "band")})


def test_feature_rows(hours):
    holed = hours.withColumn("rain", F.when(F.col("ts") != F.lit("2024-01-02 01:00:00").cast("timestamp_ntz"), F.col("rain")))
    rows = prep.feature_rows(holed)
    assert rows.count() == 480 - 60 - 1
    assert rows.columns == ["ts", *FEATURES, "building"]
    monday = rows.where("ts = TIMESTAMP_NTZ '2024-01-01 01:00:00'").first()
    assert (monday["dow"], monday["hour"], monday["day"]) == (0, 1, 1)


def test_scale_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    got = np.array([tuple(r) for r in prep.scale(df, ["a", "b"]).orderBy("a").collect()])
    a = np.array([1.0, 2.0, 4.0])
    assert got[:, 0] == pytest.approx((a - a.mean()) / a.std()) and list(got[:, 1]) == [0, 0, 0]
    other = prep.scale(df.limit(1), ["a"], fitted_on=df).first()["a"]
    assert other == pytest.approx((1 - a.mean()) / a.std())
    stage = model.fit_scaler(df, ["a", "b"]).transform(df).orderBy("a").collect()
    assert [r["scaled_a"] for r in stage] == pytest.approx(list(got[:, 0]))


def test_error_metrics(spark):
    y, p = [3.0, -0.5, 2.0, 7.0], [2.5, 0.0, 2.0, 8.0]
    df = spark.createDataFrame(list(zip(y, p)) + [(None, 1.0)], "y double, p double")
    row = metrics.error_metrics(df, "y", "p").first()
    err = np.array(y) - np.array(p)
    assert row["n"] == 4 and row["mae"] == pytest.approx(abs(err).mean())
    assert row["mse"] == pytest.approx((err**2).mean()) and row["rmse"] == pytest.approx(math.sqrt((err**2).mean()))
    assert row["r2"] == pytest.approx(1 - (err**2).sum() / ((np.array(y) - np.mean(y)) ** 2).sum())


def test_line_fit(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i + 2) for i in range(10)], "x double, y double")
    row = metrics.line_fit(df, "x", "y").first()
    assert (row["n"], row["slope"], row["intercept"]) == (10, pytest.approx(3), pytest.approx(2))


def test_split_does_not_depend_on_partitioning(hours):
    train, test = model.split(hours)
    again, _ = model.split(hours.repartition(7, "rain"))
    assert train.count() + test.count() == 480 and 0.6 < train.count() / 480 < 0.8
    assert train.select("ts").exceptAll(again.select("ts")).isEmpty()


def test_lasso_matches_its_objective(spark):
    """Minimum of 1/(2n) |y - b - xw|^2 + strength |w| for one centred input, in closed form."""
    x = np.array([-2.0, -1.0, 0.0, 1.0, 2.0])
    y = 3 * x + 1
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], f"x double, {model.LABEL} double")
    vec = model.assembler(["x"], scaled=()).transform(df)
    fit = model.lasso(model.VECTOR).fit(vec)
    n = len(x)
    want = (x @ (y - y.mean()) / n - 1.0) / (x @ x / n)
    assert fit.coefficients[0] == pytest.approx(want, rel=1e-4) and fit.intercept == pytest.approx(1, abs=1e-4)


def test_tune_picks_the_better_point(hours):
    rows = model.with_label(prep.feature_rows(hours))
    ready = model.assembler().transform(model.fit_scaler(rows).transform(rows)).select("ts", model.VECTOR, model.LABEL)
    best, point = model.tune(model.forest("f", numTrees=5), {"maxDepth": (1, 6)}, ready, folds=2)
    assert point["maxDepth"] == 6 and best.getMaxDepth() == 6


def test_stack_saves_loads_and_forecasts(spark, hours, weather_rows, tmp_path):
    train, held = model.split(model.with_label(prep.feature_rows(hours)))
    bases = [model.forest("forest", numTrees=5, maxDepth=5), model.boosted("boosted", maxIter=5, maxDepth=3)]
    folds = model.out_of_fold(
        bases, model.assembler().transform(model.fit_scaler(train).transform(train)), 2, ["ts"])
    assert folds.count() == train.count() == folds.select("ts").distinct().count()
    stack = model.fit_stack(train, bases, folds=2)
    scored = stack.transform(held)
    errors = {r["model"]: r["r2"] for r in model.evaluate(
        scored, {"forest": "forest", "boosted": "boosted", "stack": "prediction"}).collect()}
    assert set(errors) == {"forest", "boosted", "stack"} and errors["stack"] > 0.5
    path = str(tmp_path / "m")
    model.save(stack, path)
    model.save(stack, path)
    loaded = model.load(path)
    w = weather_rows(*[(f"2024-01-2{d} {h:02d}:00:00", h) for d in (1, 2) for h in range(24)])
    out = forecast.forecast_bands(loaded, w, F.lit("2024-01-21 00:00:00"))
    assert out.count() == 6 and set(out.columns) == {
        "day", "dow", "band", *SCALED_FEATURES, "building_forecast", "updated_at"}
    per_hour = forecast.score(loaded, forecast.future_rows(w))
    total = per_hour.agg(F.sum("prediction")).first()[0]
    assert out.agg(F.sum("building_forecast")).first()[0] == pytest.approx(total)
    sunday = out.where("day = DATE '2024-01-21' AND band = 2").first()
    assert sunday["dow"] == 6 and sunday["temperature_2m"] == pytest.approx(np.mean(range(9, 19)))
    refit = forecast.forecast_bands(loaded, w, F.lit("2024-01-21 00:00:00"), refit_scaler=True)
    assert refit.count() == 6


