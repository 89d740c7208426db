"""The load model: a forest and boosted trees, tuned over whole grids, under a lasso.

Rows are dealt to folds by a hash of their identity. The trees of all folds, and of
the model on all rows, grow side by side (``trees``), and a grid is read off them:

- the forest is grown once, as deep and as finely as the grid allows, with the most
  trees; every point is its first trees, cut off at a depth and a number of rows;
- boosting grows one chain per number of leaves, kind and fold to the most rounds;
  fewer rounds are the chain with the weights it had then. With dropout, a round
  leaves out some earlier trees, and their weights shrink when the new tree joins.

The model on all rows grows along with the folds, so the best point needs no fit of
its own. Base predictions for the lasso come from models that did not see the row;
the lasso is solved from the sums of these predictions (``linear``).
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspan.operators import linear, model as ml, prep
from wattspan.operators.trees import BINNED, DEEPEST, Growing, Node, Tree, binned, bins_of, bootstrap, edges_of, grow
from wattspan.schema import FEATURES, SCALED_FEATURES
from wattspan.session import discard, shared_dir
from wattspan.sources import tables

# Hyperparameter grids. A forest without a depth grows to the deepest allowed.
FOREST_GRID = {"trees": (70, 80, 100), "depth": (DEEPEST, 10, 20), "least": (2, 5, 10)}
BOOSTED_GRID = {"rounds": (70, 80, 100), "leaves": (31, 50, 100), "kind": ("gbdt", "dart")}
# Settings of boosting that no grid varies: learning rate, rows of a leaf, and the
# chances that a round drops trees at all and that it drops a given one.
RATE, LEAST_LEAF, DROPS, DROPPED = 0.1, 20, 0.5, 0.1
#: Rounds of boosting after which the sums of the trees so far are written beside the rows.
REFRESH = 10


@dataclass
class Forest:
    trees: list[Tree]
    depth: int = DEEPEST
    least: int = 2

    def value(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for tree in self.trees:
            out += tree.value[tree.reach(x, self.depth, self.least)]
        return out / max(1, len(self.trees))


@dataclass
class Boosted:
    base: float
    trees: list[Tree]
    weights: np.ndarray

    def value(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree, weight in zip(self.trees, self.weights):
            out += weight * tree.value[tree.reach(x)]
        return out


def points(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def training_rows(
    rows: DataFrame, inputs: Sequence[str], edges, folds: int, seed: int, keys: Sequence[str], label: str = ml.LABEL
) -> DataFrame:
    """Rows as trees are trained on, written once: identity, fold, target and bins."""
    spark, path = rows.sparkSession, shared_dir(rows.sparkSession, "binned")
    known = rows.where(F.col(label).isNotNull())
    identity = F.xxhash64(F.lit(seed), *[F.col(k).cast("string") for k in keys])
    binned(
        known, inputs, edges, *keys, identity.alias("h"),
        ml.row_hash(seed, keys, folds).alias("fold"), F.col(label).alias("y"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def used_bins(edges) -> int:
    return max((len(e) for e in edges), default=0) + 1


# Forests ---------------------------------------------------------------------------------


def forest_by_fold(
    rows: DataFrame, count: int, folds: int, features: int, bins: int, depth: int = DEEPEST, least: int = 2
) -> list[list[Tree]]:
    """The trees of the forest without each fold, and of that on all rows (the last)."""

    def targets(batch: pa.RecordBatch, x: np.ndarray):
        fold = batch.column("fold").to_numpy()
        drawn = bootstrap(batch.column("h").to_numpy(), np.arange(count))
        seen = fold[:, None] != np.arange(folds + 1)
        weight = (seen[:, :, None] * drawn[:, None, :]).reshape(len(fold), -1)
        return weight, np.broadcast_to(batch.column("y").to_numpy()[:, None], weight.shape)

    most = float(rows.count())
    growing = [Growing(None, depth, least, [Node(0, most)]) for _ in range(count * (folds + 1))]
    found = grow(rows.select("h", "fold", "y", "x"), growing, targets, features, bins)
    return [found[k * count : (k + 1) * count] for k in range(folds + 1)]


ERRORS = "fold int, point int, n bigint, squares double"


def _mean_errors(rows: DataFrame, task, count: int, folds: int) -> list[float]:
    """Per grid point the mean over the folds of the mean squared error on the fold."""
    sums = rows.mapInArrow(task, ERRORS).groupBy("fold", "point").agg(F.sum("n"), F.sum("squares"))
    error = np.full((folds, count), np.nan)
    for fold, point, n, squares in sums.collect():  # folds x points rows
        error[fold, point] = squares / n
    return np.nanmean(error, axis=0).tolist()


def _error_task(values, features: int, count: int, folds: int):
    """``values(fold, x)`` gives (points, rows) predictions by the models without the fold."""

    def task(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, squares = np.zeros(folds, np.int64), np.zeros((folds, count))
        for batch in found:
            fold, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy()
            x = bins_of(batch, features)
            for k in np.unique(fold).tolist():
                held = fold == k
                n[k] += held.sum()
                squares[k] += ((values(k, x[held]) - y[held]) ** 2).sum(axis=1)
        k = np.flatnonzero(n)
        columns = [
            np.repeat(k, count).astype(np.int32), np.tile(np.arange(count, dtype=np.int32), len(k)),
            np.repeat(n[k], count), squares[k].ravel(),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["fold", "point", "n", "squares"])

    return task


def tune_forest(
    rows: DataFrame, features: int, bins: int, grid: Mapping[str, Sequence] = FOREST_GRID, folds: int = 3
) -> tuple[Forest, dict]:
    """The forest of the best grid point on all rows, and the point with its error."""
    found, every = points(grid), sorted({(p["depth"], p["least"]) for p in points(grid)})
    by_fold = forest_by_fold(
        rows, max(grid["trees"]), folds, features, bins, max(grid["depth"]), min(grid["least"])
    )
    shape = [(every.index((p["depth"], p["least"])), p["trees"] - 1) for p in found]

    def values(fold: int, x: np.ndarray) -> np.ndarray:
        pruned = []
        for depth, least in every:
            each = np.stack([t.value[t.reach(x, depth, least)] for t in by_fold[fold]])
            pruned.append(np.cumsum(each, axis=0) / np.arange(1, len(each) + 1)[:, None])
        return np.stack([pruned[cut][last] for cut, last in shape])

    errors = _mean_errors(rows, _error_task(values, features, len(found), folds), len(found), folds)
    best = min(range(len(found)), key=errors.__getitem__)
    p = found[best]
    return Forest(by_fold[folds][: p["trees"]], p["depth"], p["least"]), {**p, "mse": errors[best]}


# Boosting --------------------------------------------------------------------------------


@dataclass
class Chain:
    """Boosted trees of one kind without one fold (the fold behind the last: on all rows)."""

    leaves: int
    kind: str
    fold: int
    rows: float = 0.0
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    #: The weights that the written sums hold, and those after some rounds.
    written: list[float] = field(default_factory=list)
    after: dict[int, np.ndarray] = field(default_factory=dict)

    def dropped(self, rounds: random.Random) -> list[int]:
        """The trees that the next one does without."""
        if self.kind != "dart" or rounds.random() >= DROPS:
            return []
        return [t for t in range(len(self.trees)) if rounds.random() < DROPPED]

    def add(self, tree: Tree, dropped: Sequence[int]) -> None:
        for t in dropped:
            self.weights[t] *= len(dropped) / (len(dropped) + 1)
        self.trees.append(tree)
        self.weights.append(RATE / (len(dropped) + 1))

    def changed(self, without: Sequence[int] = ()) -> list[tuple[Tree, float]]:
        """Trees whose weight is not the written one, or that are left out, and the difference."""
        now = [0.0 if t in set(without) else w for t, w in enumerate(self.weights)]
        held = self.written + [0.0] * (len(now) - len(self.written))
        return [(tree, a - b) for tree, a, b in zip(self.trees, now, held) if a != b]

    def model(self, rounds: int) -> Boosted:
        return Boosted(self.base, self.trees[:rounds], self.after[rounds])


def _sums(batch: pa.RecordBatch, x: np.ndarray, base: np.ndarray, changes) -> np.ndarray:
    """(row, chain): the written sum of every chain's trees, with some changes."""
    if "sums" in batch.schema.names:
        total = batch.column("sums").flatten().to_numpy().reshape(len(x), -1).copy()
    else:
        total = np.tile(base, (len(x), 1))
    for chain, parts in enumerate(changes):
        for tree, weight in parts:
            total[:, chain] += weight * tree.value[tree.reach(x)]
    return total


def fit_chains(
    rows: DataFrame, chains: list[Chain], keep: Sequence[int], features: int, bins: int, folds: int,
    least_leaf: int = LEAST_LEAF, seed: int = ml.SEED,
) -> None:
    """Grow all chains to the last round of ``keep`` and remember their weights at each of it."""
    spark = rows.sparkSession
    rows = rows.select("h", "fold", "y", "x")
    per_fold = {r["fold"]: r for r in rows.groupBy("fold").agg(F.sum("y").alias("y"), F.count("y").alias("n")).collect()}
    for c in chains:
        seen = [r for k, r in per_fold.items() if k != c.fold]
        c.rows = float(sum(r["n"] for r in seen))
        c.base = sum(r["y"] for r in seen) / max(1.0, c.rows)
    base, fold_of = np.array([c.base for c in chains]), np.array([c.fold for c in chains])
    # All folds of a kind drop the same trees, so that they stay comparable.
    drop = {(c.leaves, c.kind, c.fold): random.Random(f"{seed} {c.leaves} {c.kind}") for c in chains}
    written = None
    for done in range(1, max(keep) + 1):
        without = [c.dropped(drop[c.leaves, c.kind, c.fold]) for c in chains]
        changes = [c.changed(d) for c, d in zip(chains, without)]

        def targets(batch: pa.RecordBatch, x: np.ndarray):
            seen = batch.column("fold").to_numpy()[:, None] != fold_of
            rest = batch.column("y").to_numpy()[:, None] - _sums(batch, x, base, changes)
            return seen.astype(float), rest

        growing = [Growing(c.leaves, DEEPEST, 2 * least_leaf, [Node(0, c.rows)]) for c in chains]
        for c, d, tree in zip(chains, without, grow(rows, growing, targets, features, bins, least_leaf)):
            c.add(tree, d)
            if done in keep:
                c.after[done] = np.array(c.weights)
        if done % REFRESH == 0 and done < max(keep):
            rows, old = _with_sums(rows, base, [c.changed() for c in chains], features), written
            written = shared_dir(spark, "sums")
            rows.write.parquet(written)
            rows = spark.read.parquet(written)
            for c in chains:
                c.written = list(c.weights)
            if old:
                discard(spark, old)
    if written:
        discard(spark, written)


def _with_sums(rows: DataFrame, base: np.ndarray, changes, features: int) -> DataFrame:
    def task(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            total = _sums(batch, bins_of(batch, features), base, changes)
            ends = pa.array(np.arange(0, total.size + 1, len(base), dtype=np.int32))
            sums = pa.ListArray.from_arrays(ends, pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], sums], names=["h", "fold", "y", "x", "sums"])

    return rows.mapInArrow(task, f"{BINNED}, sums array<double>")


def tune_boosted(
    rows: DataFrame, features: int, bins: int, grid: Mapping[str, Sequence] = BOOSTED_GRID, folds: int = 3,
    least_leaf: int = LEAST_LEAF,
) -> tuple[Boosted, dict]:
    """The boosted trees of the best grid point on all rows, and the point with its error."""
    found = points(grid)
    chains = [
        Chain(leaves, kind, fold)
        for leaves in grid["leaves"] for kind in grid["kind"] for fold in range(folds + 1)
    ]
    of = {(c.leaves, c.kind, c.fold): c for c in chains}
    fit_chains(rows, chains, grid["rounds"], features, bins, folds, least_leaf)

    def values(fold: int, x: np.ndarray) -> np.ndarray:
        out = []
        for p in found:
            out.append(of[p["leaves"], p["kind"], fold].model(p["rounds"]).value(x))
        return np.stack(out)

    errors = _mean_errors(rows, _error_task(values, features, len(found), folds), len(found), folds)
    best = min(range(len(found)), key=errors.__getitem__)
    p = found[best]
    return of[p["leaves"], p["kind"], folds].model(p["rounds"]), {**p, "mse": errors[best]}


# The whole model -------------------------------------------------------------------------

BASES = ("forest", "boosted")
SCORES = "struct<forest: double, boosted: double, prediction: double>"


@dataclass
class Stack:
    inputs: list[str]
    edges: list[np.ndarray]
    forest: Forest
    boosted: Boosted
    intercept: float
    weights: list[float]
    #: Mean and deviation of the scaled inputs in training.
    scaling: dict[str, tuple[float, float]] = field(default_factory=dict)

    def score(self, rows: DataFrame, refit_scaler: bool = False) -> DataFrame:
        """``rows`` with ``forest``, ``boosted`` and ``prediction``; missing inputs count as lowest.

        ``refit_scaler`` gives inputs the place that they have in the batch's own scale instead of
        the training's.
        """
        if refit_scaler:
            own = prep.scale(rows.withColumns({f"_own_{c}": F.col(c) for c in self.scaling}), list(self.scaling))
            moved = {c: F.col(c) * std + mean for c, (mean, std) in self.scaling.items()}
            kept = {c: F.col(f"_own_{c}") for c in self.scaling}
            scored = self.score(own.withColumns(moved)).withColumns(kept)
            return scored.select(*rows.columns, *BASES, "prediction")

        @F.arrow_udf(SCORES)
        def scored(*columns: pa.Array) -> pa.Array:
            x = np.zeros((len(columns[0]), len(columns)), np.uint8)
            for i, (column, ends) in enumerate(zip(columns, self.edges)):
                v = column.to_numpy(zero_copy_only=False).astype(float)
                x[:, i] = np.where(np.isnan(v), 0, np.searchsorted(ends, v, "left"))
            forest, boosted = self.forest.value(x), self.boosted.value(x)
            stack = self.intercept + self.weights[0] * forest + self.weights[1] * boosted
            return pa.StructArray.from_arrays([pa.array(v) for v in (forest, boosted, stack)], [*BASES, "prediction"])

        inputs = [F.col(c).cast("double") for c in self.inputs]
        found = rows.withColumn("_scores", scored(*inputs))
        return found.withColumns({c: F.col(f"_scores.{c}") for c in (*BASES, "prediction")}).drop("_scores")


def out_of_fold(
    rows: DataFrame, forest: Forest, point: Mapping, folds: int, features: int, bins: int, least_leaf: int = LEAST_LEAF
) -> DataFrame:
    """Label and base predictions of every row by models that did not see its fold."""
    by_fold = forest_by_fold(rows, len(forest.trees), folds, features, bins, forest.depth, forest.least)
    chains = [Chain(point["leaves"], point["kind"], k) for k in range(folds)]
    fit_chains(rows, chains, (point["rounds"],), features, bins, folds, least_leaf)
    forests = [Forest(f, forest.depth, forest.least) for f in by_fold[:folds]]
    boosts = [c.model(point["rounds"]) for c in chains]

    def task(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            fold, x = batch.column("fold").to_numpy(), bins_of(batch, features)
            out = np.zeros((2, len(fold)))
            for k in np.unique(fold).tolist():
                held = fold == k
                out[:, held] = forests[k].value(x[held]), boosts[k].value(x[held])
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("y"), *map(pa.array, out)], names=["h", ml.LABEL, *BASES]
            )

    schema = f"h bigint, {ml.LABEL} double, forest double, boosted double"
    return rows.select("h", "fold", "y", "x").mapInArrow(task, schema)


def fit(
    train: DataFrame,
    forest_grid: Mapping[str, Sequence] = FOREST_GRID,
    boosted_grid: Mapping[str, Sequence] = BOOSTED_GRID,
    folds: int = 5,
    search_folds: int = 3,
    keys: Sequence[str] = ("ts",),
    inputs: Sequence[str] = FEATURES,
    strength: float = 1.0,
    least_leaf: int = LEAST_LEAF,
) -> tuple[Stack, dict]:
    """Tune both bases on ``train``, stack them, and tell the points chosen."""
    edges = edges_of(train, inputs)
    size = (len(inputs), used_bins(edges))
    searched = training_rows(train, inputs, edges, search_folds, ml.SEED + 1, keys)
    forest, forest_point = tune_forest(searched, *size, forest_grid, search_folds)
    boosted, boosted_point = tune_boosted(searched, *size, boosted_grid, search_folds, least_leaf)
    dealt = training_rows(train, inputs, edges, folds, ml.SEED + 2, keys)
    held = out_of_fold(dealt, forest, boosted_point, folds, *size, least_leaf)
    meta = linear.fit(linear.state(held, BASES, ml.LABEL), strength).first()["fit"]
    scaled = [c for c in inputs if c in SCALED_FEATURES]
    stats = prep.scaler_stats(train, scaled).first() if scaled else {}
    scaling = {c: (stats[c]["mean"], stats[c]["std"] or 1.0) for c in scaled}
    stack = Stack(list(inputs), edges, forest, boosted, meta["intercept"], list(meta["weights"]), scaling)
    return stack, {"forest": forest_point, "boosted": boosted_point}


# Storage ---------------------------------------------------------------------------------

TREES = (
    "part string, number int, weight double, feature array<int>, cut array<int>, left array<int>, right array<int>, "
    "rows array<bigint>, value array<double>"
)
SETTINGS = (
    "inputs array<string>, edges array<array<double>>, depth int, least int, base double, intercept double, "
    "weights array<double>, scaling map<string, array<double>>"
)


def write(spark: SparkSession, stack: Stack, path: str) -> None:
    """The model as two small tables: a row per tree, and one row of settings."""
    rows = [
        (part, i, float(w), *t.plain().values())
        for part, held, weights in (
            ("forest", stack.forest.trees, [1.0] * len(stack.forest.trees)),
            ("boosted", stack.boosted.trees, stack.boosted.weights),
        )
        for i, (t, w) in enumerate(zip(held, weights))
    ]
    spark.createDataFrame(rows, TREES).write.parquet(f"{path}/trees")
    settings = (
        stack.inputs, [e.tolist() for e in stack.edges], stack.forest.depth, stack.forest.least,
        float(stack.boosted.base), stack.intercept, stack.weights, {c: list(v) for c, v in stack.scaling.items()},
    )
    spark.createDataFrame([settings], SETTINGS).coalesce(1).write.parquet(f"{path}/settings")


def read(spark: SparkSession, path: str) -> Stack:
    s = spark.read.parquet(f"{path}/settings").first()
    held = {"forest": [], "boosted": []}
    for row in sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r["number"]):
        held[row["part"]].append((Tree.of(row.asDict()), row["weight"]))
    boosted = Boosted(s["base"], [t for t, _ in held["boosted"]], np.array([w for _, w in held["boosted"]]))
    return Stack(
        list(s["inputs"]), [np.array(e) for e in s["edges"]],
        Forest([t for t, _ in held["forest"]], s["depth"], s["least"]), boosted, s["intercept"], list(s["weights"]),
        {c: tuple(v) for c, v in s["scaling"].items()},
    )


MODEL = "model"


def save(spark: SparkSession, stack: Stack, path: str) -> None:
    """Write a model beside the ones before it, then make it the current one."""
    tables.put(spark, path, MODEL, lambda folder: write(spark, stack, folder))


def load(spark: SparkSession, path: str) -> Stack:
    """The current model."""
    return read(spark, tables.parts(spark, path)[MODEL])
