"""Trees, grids and stacks against plain growers on small tables."""

from __future__ import annotations

import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.operators import ensemble, model, trees
from wattspan.operators.trees import Growing, Node, Tree

FEATURES, BINS = 4, 6


@pytest.fixture(scope="module")
def table(spark):
    """Rows with whole targets, so that sums are exact whatever their order."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, BINS, (240, FEATURES)).astype(np.uint8)
    y = np.floor(x[:, 0] * 7.0 + (x[:, 1] > 2) * 40 * (x[:, 2] > 1) + rng.integers(-6, 7, 240))
    h = rng.integers(-(2**62), 2**62, 240)
    fold = (np.arange(240) % 3).astype(int)
    data = [(int(a), int(k), float(t), bytearray(b.tobytes())) for a, k, t, b in zip(h, fold, y, x)]
    rows = spark.createDataFrame(data, trees.BINNED).repartition(5)
    return rows, h, fold, y, x


def plain(x, w, r, leaves=None, depth=30, least=2, least_leaf=1):
    """Best leaf first, one cut after the other, every cut tried."""

    def cut(rows):
        a, s, best = w[rows].sum(), (w * r)[rows].sum(), None
        for f in range(x.shape[1]):
            for b in range(BINS):
                left = rows[x[rows, f] <= b]
                if len(left) < least_leaf or len(rows) - len(left) < least_leaf:
                    continue
                lw, ls = w[left].sum(), (w * r)[left].sum()
                gain = round(ls**2 / lw + (s - ls) ** 2 / (a - lw) - s**2 / a, 6)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, f, b
        return best

    nodes, heap, done = [], [], 0

    def add(rows, level):
        at = len(nodes)
        nodes.append({"rows": rows, "value": (w * r)[rows].sum() / w[rows].sum(), "cut": None})
        best = cut(rows) if len(rows) >= least and level < depth else None
        if best:
            heapq.heappush(heap, (-best[0], at, best, level))
        return at

    add(np.flatnonzero(w > 0), 0)
    while heap and (leaves is None or done < leaves - 1):
        _, at, (_, f, b), level = heapq.heappop(heap)
        rows = nodes[at]["rows"]
        left = x[rows, f] <= b
        nodes[at]["cut"] = (f, b, add(rows[left], level + 1), add(rows[~left], level + 1))
        done += 1

    def value(row):
        at = 0
        while nodes[at]["cut"]:
            f, b, left, right = nodes[at]["cut"]
            at = left if row[f] <= b else right
        return nodes[at]["value"]

    return np.array([value(row) for row in x]), sum(n["cut"] is None for n in nodes)


def one_target(w, r):
    def targets(batch, x):
        at = batch.column("h").to_numpy()
        return w(at), r(at)

    return targets


SHAPES = [(None, 30, 2, 1), (None, 3, 2, 1), (None, 30, 25, 1), (7, 30, 2, 1), (20, 30, 2, 8), (1, 30, 2, 1)]


@pytest.mark.parametrize("local", [0, 40, 4096])
def test_trees_equal_a_plain_grower(table, monkeypatch, local):
    # Whole trees in one task, branches of small nodes, and sums per cell only.
    monkeypatch.setattr(trees, "LOCAL", local)
    monkeypatch.setattr(trees, "OPEN", 11)
    rows, h, _, y, x = table
    for least_leaf in (1, 8):
        shapes = [s for s in SHAPES if s[3] == least_leaf]
        growing = [Growing(leaves, depth, least, [Node(0, 240.0)]) for leaves, depth, least, _ in shapes]

        def targets(batch, _):
            weight = trees.bootstrap(batch.column("h").to_numpy(), np.arange(len(shapes)))
            return weight, np.broadcast_to(batch.column("y").to_numpy()[:, None], weight.shape)

        drawn = trees.bootstrap(h, np.arange(len(shapes)))
        for k, tree in enumerate(trees.grow(rows, growing, targets, FEATURES, BINS, least_leaf)):
            want, leaves = plain(x, drawn[:, k], y, *shapes[k])
            assert (tree.feature < 0).sum() == leaves
            assert tree.value[tree.reach(x)] == pytest.approx(want, rel=1e-12)


def test_wide_cells_are_kept_sparse(table, monkeypatch):
    monkeypatch.setattr(trees, "LOCAL", 0)
    rows, _, _, y, x = table
    same = []
    for dense in (1 << 21, 50):
        monkeypatch.setattr(trees, "DENSE", dense)
        growing = [Growing(9, 30, 2, [Node(0, 240.0)])]
        targets = lambda b, _: (np.ones((b.num_rows, 1)), b.column("y").to_numpy()[:, None])
        same.append(trees.grow(rows, growing, targets, FEATURES, BINS)[0].plain())
    assert same[0] == same[1]


def test_a_smaller_tree_is_the_larger_one_cut_off(table):
    rows, *_ , x = table
    deep = ensemble.forest_by_fold(rows, 4, 3, FEATURES, BINS)
    for depth, least in ((2, 2), (30, 30), (3, 12)):
        own = ensemble.forest_by_fold(rows, 4, 3, FEATURES, BINS, depth, least)
        for a, b in zip(deep, own):
            for whole, small in zip(a, b):
                assert (whole.value[whole.reach(x, depth, least)] == small.value[small.reach(x)]).all()


@pytest.mark.parametrize("kind", ["gbdt", "dart"])
def test_fewer_rounds_are_the_first_of_more(table, monkeypatch, kind):
    monkeypatch.setattr(ensemble, "REFRESH", 3)
    monkeypatch.setattr(ensemble, "DROPPED", 0.4)
    rows, *_, x = table
    grid = {"rounds": (4, 9), "leaves": (5,), "kind": (kind,)}
    chains = [ensemble.Chain(5, kind, 3)]
    ensemble.fit_chains(rows, chains, grid["rounds"], FEATURES, BINS, 3, 5)
    alone = [ensemble.Chain(5, kind, 3)]
    ensemble.fit_chains(rows, alone, (4,), FEATURES, BINS, 3, 5)
    assert chains[0].model(4).value(x) == pytest.approx(alone[0].model(4).value(x), rel=1e-9)


@pytest.mark.parametrize("kind", ["gbdt", "dart"])
def test_boosting_equals_plain_boosting(table, monkeypatch, kind):
    monkeypatch.setattr(ensemble, "REFRESH", 4)
    monkeypatch.setattr(ensemble, "DROPPED", 0.4)
    rows, h, fold, y, x = table
    chain = ensemble.Chain(4, kind, 1)
    ensemble.fit_chains(rows, [chain], (10,), FEATURES, BINS, 3, 6)
    seen, drop = fold != 1, random.Random(f"{model.SEED} 4 {kind}")
    base, values, weights, skipped = y[seen].mean(), [], [], 0
    for _ in range(10):
        out = []
        if kind == "dart" and drop.random() < ensemble.DROPS:
            out = [t for t in range(len(values)) if drop.random() < 0.4]
        skipped += len(out)
        now = base + sum(w * v for t, (w, v) in enumerate(zip(weights, values)) if t not in out)
        found, _ = plain(x, seen.astype(float), y - now, 4, 30, 12, 6)
        for t in out:
            weights[t] *= len(out) / (len(out) + 1)
        values.append(found)
        weights.append(ensemble.RATE / (len(out) + 1))
    assert (kind == "dart") == (skipped > 0)
    want = base + sum(w * v for w, v in zip(weights, values))
    assert chain.model(10).value(x) == pytest.approx(want, rel=1e-6)


def test_the_grid_is_scored_as_every_point_alone(table):
    rows, h, fold, y, x = table
    grid = {"trees": (3, 5), "depth": (2, 30), "least": (2, 40)}
    best, point = ensemble.tune_forest(rows, FEATURES, BINS, grid, 3)
    by_point = {}
    for p in ensemble.points(grid):
        forests = ensemble.forest_by_fold(rows, p["trees"], 3, FEATURES, BINS, p["depth"], p["least"])
        errors = [
            ((ensemble.Forest(f).value(x[fold == k]) - y[fold == k]) ** 2).mean() for k, f in enumerate(forests[:3])
        ]
        by_point[tuple(p.values())] = np.mean(errors), forests[3]
    chosen = min(by_point, key=lambda p: by_point[p][0])
    assert chosen == (point["trees"], point["depth"], point["least"])
    assert point["mse"] == pytest.approx(by_point[chosen][0])
    assert best.value(x) == pytest.approx(ensemble.Forest(by_point[chosen][1]).value(x))


def test_the_grid_of_boosting(table):
    rows, _, fold, y, x = table
    grid = {"rounds": (3, 6), "leaves": (2, 6), "kind": ("gbdt", "dart")}
    best, point = ensemble.tune_boosted(rows, FEATURES, BINS, grid, 3, 5)
    chains = [ensemble.Chain(point["leaves"], point["kind"], k) for k in range(4)]
    ensemble.fit_chains(rows, chains, (point["rounds"],), FEATURES, BINS, 3, 5)
    errors = [((c.model(point["rounds"]).value(x[fold == c.fold]) - y[fold == c.fold]) ** 2).mean() for c in chains[:3]]
    assert point["mse"] == pytest.approx(np.mean(errors))
    assert best.value(x) == pytest.approx(chains[3].model(point["rounds"]).value(x))


def test_bootstrap_draws_like_a_sample():
    drawn = trees.bootstrap(np.arange(20_000), np.arange(5))
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.04)
    assert np.abs(np.corrcoef(drawn.T) - np.eye(5)).max() < 0.03


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(0, 1, 400), rng.normal(5, 2, 400)
    y = np.where(a > 0, 30, 10) + 3 * b + rng.normal(0, 1, 400)
    data = [(i, float(p), float(q), float(t)) for i, (p, q, t) in enumerate(zip(a, b, y))]
    data += [(400, None, 1.0, 5.0), (401, 0.5, 1.0, None)]
    return spark.createDataFrame(data, f"id int, a double, temperature_2m double, {model.LABEL} double").repartition(4)


SMALL = ({"trees": (10, 20), "depth": (3, 30), "least": (2, 10)}, {"rounds": (20, 40), "leaves": (4, 8), "kind": ("gbdt", "dart")})


def test_a_stack_is_saved_and_scores_alike(spark, raw, tmp_path):
    train, test = raw.where("id % 4 != 0"), raw.where("id % 4 = 0")
    stack, found = ensemble.fit(train, *SMALL, folds=3, search_folds=3, keys=["id"], inputs=["a", "temperature_2m"], least_leaf=5)
    assert found["boosted"]["rounds"] in (20, 40) and found["forest"]["least"] in (2, 10)
    names = {"forest": "forest", "boosted": "boosted", "stack": "prediction"}
    errors = {r["model"]: r["r2"] for r in model.evaluate(stack.score(test), names).collect()}
    assert errors["forest"] > 0.8 and errors["boosted"] > 0.8 and errors["stack"] > 0.8
    path = str(tmp_path / "m")
    ensemble.save(spark, stack, path)
    again = ensemble.load(spark, path).score(test).orderBy("id").collect()
    assert [r["prediction"] for r in again] == [r["prediction"] for r in stack.score(test).orderBy("id").collect()]
    # On the training's own rows the batch's scale is the training's.
    own = stack.score(train, refit_scaler=True).orderBy("id").collect()
    near = [abs(a["prediction"] - b["prediction"]) for a, b in zip(own, stack.score(train).orderBy("id").collect())]
    assert np.median(near) < 1e-9 and [c for c in own[0].asDict()] == [*train.columns, "forest", "boosted", "prediction"]


def test_values_out_of_fold_are_by_models_without_the_row(spark, raw):
    train = raw.where(f"{model.LABEL} IS NOT NULL")
    edges = ensemble.edges_of(train, ["a", "temperature_2m"])
    size = (2, ensemble.used_bins(edges))
    rows = ensemble.training_rows(train, ["a", "temperature_2m"], edges, 2, 1, ["id"])
    forest = ensemble.Forest([None] * 3, 4, 2)
    point = {"rounds": 3, "leaves": 4, "kind": "gbdt"}
    held = {r["h"]: r for r in ensemble.out_of_fold(rows, forest, point, 2, *size, 5).collect()}
    by_fold = ensemble.forest_by_fold(rows, 3, 2, *size, 4, 2)
    for row in rows.limit(50).collect():
        x = np.frombuffer(bytes(row["x"]), np.uint8)[None]
        assert held[row["h"]]["forest"] == ensemble.Forest(by_fold[row["fold"]], 4, 2).value(x)[0]
    assert len(held) == train.count()
