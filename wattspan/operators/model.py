"""Training of the load regressors on MLlib.

Rows are dealt to train, test and folds by a hash of their identity, so a row
falls on the same side however the data is partitioned or recomputed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from wattspan.operators import metrics, prep
from wattspan.schema import FEATURES, SCALED_FEATURES, TARGET

SEED = 70
LABEL = "label"
VECTOR = "features"
# Deepest tree the library grows: stands for an unlimited depth.
DEEPEST = 30

# Hyperparameter grids. A minimum split of n rows becomes leaves
# of at least n/2; a number of leaves becomes the depth that holds them.
FOREST_GRID = {"numTrees": (70, 80, 100), "maxDepth": (DEEPEST, 10, 20),
               "minInstancesPerNode": (1, 2, 5)}
BOOSTED_GRID = {"maxIter": (70, 80, 100), "maxDepth": (5, 6, 7)}


def row_hash(seed: int, keys: Sequence[str], buckets: int) -> Column:
    """A number under ``buckets`` from the keys as text, by a hash that any SQL engine has."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    digits = F.substring(F.md5(text.cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % buckets).cast("int")


def split(
    df: DataFrame, train_percent: int = 70, seed: int = SEED, keys: Sequence[str] = ("ts",)
) -> tuple[DataFrame, DataFrame]:
    side = row_hash(seed, keys, 100)
    return df.where(side < train_percent), df.where(side >= train_percent)


def fit_scaler(train: DataFrame, columns: Sequence[str] = SCALED_FEATURES) -> SQLTransformer:
    """A pipeline stage that scales ``columns`` by the training statistics.

    MLlib's own scaler divides by the sample deviation. The statistics are one
    row of two numbers per column.
    """
    stats = prep.scaler_stats(train, columns).first()
    scaled = []
    for c in columns:
        mean, std = stats[c]["mean"], stats[c]["std"] or 1.0
        scaled.append(f"(`{c}` - {mean!r}D) / {std!r}D AS `scaled_{c}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def assembler(inputs: Sequence[str] = FEATURES, scaled: Sequence[str] = SCALED_FEATURES):
    names = [f"scaled_{c}" if c in scaled else c for c in inputs]
    return VectorAssembler(inputCols=names, outputCol=VECTOR)


def with_label(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.withColumn(LABEL, F.col(target).cast("double"))


def forest(output: str = "prediction", **params) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=VECTOR, labelCol=LABEL, predictionCol=output, seed=SEED, **params
    )


def boosted(output: str = "prediction", **params) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=VECTOR, labelCol=LABEL, predictionCol=output, seed=SEED, **params
    )


def linear(inputs: str = VECTOR, output: str = "prediction", **params) -> LinearRegression:
    return LinearRegression(featuresCol=inputs, labelCol=LABEL, predictionCol=output, **params)


def lasso(inputs: str, output: str = "prediction", strength: float = 1.0) -> LinearRegression:
    return linear(
        inputs, output, elasticNetParam=1.0, regParam=strength, standardization=False
    )


def tune(
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    rows: DataFrame,
    folds: int = 3,
    parallelism: int = 4,
    keys: Sequence[str] = ("ts",),
) -> tuple[Estimator, dict]:
    """The estimator with the grid point of the lowest cross-validated error."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    points = builder.build()
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=points,
        evaluator=RegressionEvaluator(
            labelCol=LABEL, predictionCol=estimator.getPredictionCol(), metricName="mse"
        ),
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
    )
    dealt = rows.withColumn("_fold", row_hash(SEED + 1, keys, folds))
    scores = search.fit(dealt).avgMetrics
    best = min(range(len(points)), key=scores.__getitem__)
    chosen = {p.name: v for p, v in points[best].items()}
    return estimator.copy(points[best]), {**chosen, "mse": scores[best]}


def out_of_fold(
    bases: Sequence[Estimator], rows: DataFrame, folds: int, keys: Sequence[str]
) -> DataFrame:
    """Base predictions for every row by models that did not see it."""
    dealt = rows.withColumn("_fold", row_hash(SEED + 2, keys, folds))
    parts = []
    for k in range(folds):
        seen, held = dealt.where(F.col("_fold") != k), dealt.where(F.col("_fold") == k)
        for base in bases:
            held = base.fit(seen).transform(held)
        parts.append(held.select(*keys, LABEL, *[b.getPredictionCol() for b in bases]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fit_stack(
    train: DataFrame,
    bases: Sequence[Estimator],
    folds: int = 5,
    keys: Sequence[str] = ("ts",),
) -> PipelineModel:
    """Scaler, base models and a lasso over their predictions, as one pipeline.

    ``train`` holds unscaled feature rows with a label; every base writes its
    own prediction column.
    """
    names = [b.getPredictionCol() for b in bases]
    front = [fit_scaler(train), assembler()]
    ready = PipelineModel(front).transform(train).select(*keys, VECTOR, LABEL)
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        meta_input = VectorAssembler(inputCols=names, outputCol="base_predictions")
        meta = Pipeline(stages=[meta_input, lasso("base_predictions")]).fit(
            out_of_fold(bases, ready, folds, keys)
        )
        fitted: list[Model] = [b.fit(ready) for b in bases]
    finally:
        ready.unpersist()
    return PipelineModel([*front, *fitted, *meta.stages])


def evaluate(scored: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Error measures per model; ``columns`` maps a name to its prediction column."""
    entries = F.array(
        *[
            F.struct(F.lit(n).alias("model"), F.col(c).alias("predicted"))
            for n, c in columns.items()
        ]
    )
    long = scored.select(LABEL, F.inline(entries))
    return metrics.error_metrics(long, LABEL, "predicted", ["model"])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
