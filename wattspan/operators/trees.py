"""Regression trees grown best leaf first, many of them in one pass over the rows.

Features are cut into bins once. A pass sends the trees grown so far to the rows;
every row walks all of them, and each partition sums rows, weights and targets per
(open node, feature, bin). Spark adds the partitions' sums, runs along the bins of a
feature and keeps the best cut of a node, so what comes back is one row per open
node. A node's cut depends on its own rows only. Hence

- trees of a forest, folds and chains of boosted trees grow side by side, and a pass
  costs one read of the rows however many they are;
- a tree with a limit of leaves takes the best cut first: all nodes that this order
  reaches are opened at once, and the order is taken again with what they bring,
  until nothing new is reached. Passes follow the depth of a tree, not its leaves;
- a node of at most ``LOCAL`` rows goes to one task with its rows and comes back with
  all that grows below it, by the same cuts;
- a tree with less depth, or more rows needed to split, is the same tree cut off
  earlier, a smaller forest its first trees, and fewer rounds of boosting the first
  rounds. One fit scores a whole grid (``ensemble``).

Sums travel as cells that occur, at most (open nodes x features x bins) per partition;
open nodes are taken some at a time. Rows may lie anywhere: weights come from a hash
of the row's identity. The driver holds the trees.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BINS = 255
# Open nodes per pass, and (row, tree) pairs a task looks at together.
OPEN, PAIRS = 40_000, 1 << 19
# Rows of a node that one task takes over.
LOCAL = 4096
# Cells that a task keeps as plain arrays; beyond, only those that occur.
DENSE = 1 << 21
DEEPEST = 30

# A row as it is trained on: identity, fold, target, bins of its features.
BINNED = "h bigint, fold int, y double, x binary"


@dataclass
class Tree:
    """Nodes in the order they were made; feature -1 is a leaf. ``rows`` counts training rows,
    ``value`` is their weighted mean, also in nodes that are cut."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    rows: np.ndarray
    value: np.ndarray

    def plain(self) -> dict:
        return {k: v.tolist() for k, v in self.__dict__.items()}

    @classmethod
    def of(cls, plain: dict) -> Tree:
        kinds = dict.fromkeys(("feature", "cut", "left", "right"), np.int32) | {"rows": np.int64, "value": float}
        return cls(**{k: np.array(plain[k], t) for k, t in kinds.items()})

    def reach(self, x: np.ndarray, depth: int = DEEPEST, least: int = 2) -> np.ndarray:
        """The node where each row ends, no deeper than ``depth`` and cutting no node of fewer
        than ``least`` rows."""
        node, every = np.zeros(len(x), np.int32), np.arange(len(x))
        cuts = (self.feature >= 0) & (self.rows >= least)
        for _ in range(depth):
            inner = cuts[node]
            if not inner.any():
                break
            right = x[every, self.feature[node]] > self.cut[node]
            node = np.where(inner, np.where(right, self.right[node], self.left[node]), node)
        return node


@dataclass
class Node:
    depth: int
    rows: float = 0.0
    weight: float = 0.0
    total: float = 0.0
    #: (gain, feature, cut, left rows, left weight, left total); None while it is not known.
    best: tuple | None = None
    known: bool = False
    children: tuple[int, int] | None = None


@dataclass
class Growing:
    """A tree while it grows, with more nodes than it may keep."""

    leaves: int | None = None
    depth: int = DEEPEST
    least: int = 2
    nodes: list[Node] = field(default_factory=lambda: [Node(0, float("inf"))])

    def select(self) -> tuple[list[int], list[int]]:
        """The nodes cut when the best known cut is always taken first, and those opened by it."""
        chosen, opened, heap = [], [], []

        def push(i: int) -> None:
            node = self.nodes[i]
            if node.best and node.depth < self.depth and node.rows >= self.least:
                heapq.heappush(heap, (-node.best[0], i))

        push(0)
        while heap and (self.leaves is None or len(chosen) < self.leaves - 1):
            i = heapq.heappop(heap)[1]
            chosen.append(i)
            node = self.nodes[i]
            if node.children is None:
                at = len(self.nodes)
                node.children = (at, at + 1)
                _, _, _, rows, weight, total = node.best
                self.nodes.append(Node(node.depth + 1, rows, weight, total))
                self.nodes.append(
                    Node(node.depth + 1, node.rows - rows, node.weight - weight, node.total - total)
                )
                opened += node.children
            for child in node.children:
                if self.nodes[child].known:
                    push(child)
        return chosen, opened

    def finished(self) -> Tree:
        chosen, order = set(self.select()[0]), [0]
        for i in order:  # grows while it is walked
            if i in chosen:
                order += self.nodes[i].children
        at = {i: k for k, i in enumerate(order)}
        rows = []
        for i in order:
            n = self.nodes[i]
            cut = (n.best[1], n.best[2], *(at[c] for c in n.children)) if i in chosen else (-1, 0, 0, 0)
            rows.append((*cut, n.rows, n.total / n.weight if n.weight else 0.0))
        feature, cut, left, right, count, value = zip(*rows)
        return Tree.of({"feature": feature, "cut": cut, "left": left, "right": right, "rows": count, "value": value})


@dataclass
class Packed:
    """All growing trees in one set of arrays, for the walk of a task."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: np.ndarray
    #: By node: its number among the open nodes of this pass, or -1.
    open: np.ndarray


def _packed(growing: Sequence[Growing], wanted: Sequence[tuple[int, int]]) -> Packed:
    sizes = np.cumsum([0, *(len(g.nodes) for g in growing)])
    feature, cut = np.full(sizes[-1], -1, np.int32), np.zeros(sizes[-1], np.int32)
    left, right = np.zeros((2, sizes[-1]), np.int32)
    opened = np.full(sizes[-1], -1, np.int32)
    for base, g in zip(sizes.tolist(), growing):
        for i, node in enumerate(g.nodes):
            if node.children:
                feature[base + i], cut[base + i] = node.best[1], node.best[2]
                left[base + i], right[base + i] = base + node.children[0], base + node.children[1]
    for number, (tree, i) in enumerate(wanted):
        opened[sizes[tree] + i] = number
    return Packed(feature, cut, left, right, sizes[:-1].astype(np.int32), opened)


def bins_of(batch: pa.RecordBatch, features: int, column: str = "x") -> np.ndarray:
    raw = b"".join(batch.column(column).to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(-1, features)


#: From a batch to the weight and the target of every (row, tree).
Targets = Callable[[pa.RecordBatch, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _open_pairs(packed: Packed, targets: Targets, features: int, batch: pa.RecordBatch):
    """(x, row, open node, weight, target) of the rows that lie in open nodes, a part at a time."""
    step = max(1, PAIRS // len(packed.roots))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        x = bins_of(part, features)
        weight, target = targets(part, x)
        node = np.broadcast_to(packed.roots, weight.shape).copy()
        row = np.arange(len(x))[:, None]
        while True:
            cut = packed.feature[node]
            inner = cut >= 0
            if not inner.any():
                break
            over = x[row, cut] > packed.cut[node]
            node = np.where(inner, np.where(over, packed.right[node], packed.left[node]), node)
        number = np.where(weight > 0, packed.open[node], -1)
        r, m = np.nonzero(number >= 0)
        if len(r):
            yield x, r, number[r, m].astype(np.int64), weight[r, m], target[r, m]


def _cells(packed: Packed, targets: Targets, features: int, bins: int, opened: int):
    """The task of a pass: sums of its rows per (open node, feature, bin)."""
    size = opened * features * bins
    across = np.arange(features) * bins

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((3, size)) if size <= DENSE else None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def gathered() -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            sums = np.concatenate([v for _, v in held], axis=1)
            return keys, np.stack([np.bincount(place, v, len(keys)) for v in sums])

        for batch in found:
            for x, r, number, w, target in _open_pairs(packed, targets, features, batch):
                keys = (number * features * bins)[:, None] + across + x[r]
                flat = keys.ravel()
                values = np.repeat(np.stack([np.ones(len(r)), w, w * target]), features, axis=1)
                if dense is not None:
                    for total, v in zip(dense, values):
                        total += np.bincount(flat, v, size)
                else:
                    held.append((flat, values))
                    if sum(len(k) for k, _ in held) > DENSE:
                        held[:] = [gathered()]
        if dense is not None:
            keys = np.flatnonzero(dense[0])
            sums = dense[:, keys]
        elif held:
            keys, sums = gathered()
        else:
            return
        cell, at_bin = np.divmod(keys, bins)
        node, feature = np.divmod(cell, features)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(feature.astype(np.int32)), pa.array(at_bin.astype(np.int32)), *map(pa.array, sums)],
            names=["node", "feature", "bin", "n", "w", "s"],
        )

    return batches


ROW = "node bigint, w double, r double, x binary"
BRANCH = (
    "node bigint, gain array<double>, feature array<int>, cut array<int>, left array<int>, "
    "rows array<double>, weight array<double>, total array<double>"
)


def _rows_of(packed: Packed, targets: Targets, features: int):
    """The task that sends the rows of small open nodes on their way, with weight and target."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for x, r, number, w, target in _open_pairs(packed, targets, features, batch):
                ends = pa.py_buffer(np.arange(0, (len(r) + 1) * features, features, dtype=np.int32))
                raw = pa.Array.from_buffers(pa.binary(), len(r), [None, ends, pa.py_buffer(x[r].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number), pa.array(w), pa.array(target), raw], names=["node", "w", "r", "x"]
                )

    return batches


def cut_of(x: np.ndarray, w: np.ndarray, r: np.ndarray, bins: int, least_leaf: int):
    """The best cut of one node's rows, as ``BEST_CUTS`` finds it."""
    features = x.shape[1]
    keys = (np.arange(features) * bins + x).ravel()
    n, lw, ls = (
        np.bincount(keys, v, features * bins).reshape(features, bins).cumsum(axis=1)
        for v in (np.ones(len(keys)), np.repeat(w, features), np.repeat(w * r, features))
    )
    an, aw, as_ = n[0, -1], lw[0, -1], ls[0, -1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ls**2 / lw + (as_ - ls) ** 2 / (aw - lw) - as_**2 / aw
    gain = np.where((n >= least_leaf) & (an - n >= least_leaf), np.round(gain, 6), 0.0)
    at = int(gain.argmax())  # the first of equals: lowest feature, then lowest bin
    if not gain.flat[at] > 0:
        return None
    return gain.flat[at], at // bins, at % bins, n.flat[at], lw.flat[at], ls.flat[at]


def _branch(x: np.ndarray, w: np.ndarray, r: np.ndarray, bins: int, least_leaf: int, growing: Growing) -> list[Node]:
    """All that grows from one node's rows; children follow one another."""
    held = [np.arange(len(w))]
    nodes, rest = growing.nodes, [0]
    nodes[0] = Node(nodes[0].depth, len(w), w.sum(), (w * r).sum())
    while rest:
        for i in rest:
            part, node = held[i], nodes[i]
            node.known = True
            if node.rows >= growing.least and node.depth < growing.depth:
                node.best = cut_of(x[part], w[part], r[part], bins, least_leaf)
        chosen, rest = growing.select()
        for i in chosen:
            if nodes[i].children[1] >= len(held):
                right = x[held[i], nodes[i].best[1]] > nodes[i].best[2]
                held += [held[i][~right], held[i][right]]
    return nodes


def _branches(numbers: dict[int, tuple], features: int, bins: int, least_leaf: int):
    """The task that takes small nodes over: rows of a node in, its branch out."""

    def grown(rows: pa.Table) -> pa.Table:
        number = rows["node"][0].as_py()
        leaves, depth, least, at = numbers[number]
        x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.uint8).reshape(-1, features)
        nodes = _branch(
            x, rows["w"].to_numpy(), rows["r"].to_numpy(), bins, least_leaf, Growing(leaves, depth, least, [Node(at)])
        )
        best = [n.best or (0.0, -1, 0) for n in nodes]
        columns = {
            "gain": [b[0] for b in best], "feature": [b[1] for b in best], "cut": [b[2] for b in best],
            "left": [n.children[0] if n.children else -1 for n in nodes],
            "rows": [n.rows for n in nodes], "weight": [n.weight for n in nodes], "total": [n.total for n in nodes],
        }
        kinds = {c: pa.int32() if c in ("feature", "cut", "left") else pa.float64() for c in columns}
        return pa.table({"node": pa.array([number], pa.int64())} | {
            c: pa.array([v], pa.list_(kinds[c])) for c, v in columns.items()
        })

    return grown


def _graft(growing: Growing, at: int, found) -> None:
    """Put a branch in the place of an open node."""
    nodes, base = growing.nodes, len(growing.nodes) - 1
    place = [at, *range(base + 1, base + len(found["gain"]))]
    nodes += [Node(0) for _ in place[1:]]
    depth = {0: nodes[at].depth}
    for k, gain in enumerate(found["gain"]):
        node = nodes[place[k]]
        node.depth, node.known = depth[k], True
        node.rows, node.weight, node.total = found["rows"][k], found["weight"][k], found["total"][k]
        left = found["left"][k]
        if left >= 0:
            node.children = (place[left], place[left + 1])
            depth[left] = depth[left + 1] = node.depth + 1
        if gain > 0:
            # A cut that was not taken tells no sums of its sides; they are found if it is opened.
            sides = (found["rows"][left], found["weight"][left], found["total"][left]) if left >= 0 else (0.0, 0.0, 0.0)
            node.best = (gain, found["feature"][k], found["cut"][k], *sides)


CELL = "node bigint, feature int, bin int, n double, w double, s double"


def best_cuts(cells: DataFrame, least_leaf: int) -> DataFrame:
    """Per node its sums and the cut that leaves the least squared error, if any cut does.

    Gains are compared to six digits after the point, so that the order in which
    partitions were added does not choose; equal ones go to the lower feature and cut.
    """
    # Dealt by node, all that follows finds its rows together.
    return cells.sparkSession.sql(
        BEST_CUTS, args={"least": least_leaf}, cells=cells.repartition("node")
    )


BEST_CUTS = """
WITH summed AS (
  SELECT node, feature, bin, sum(n) AS n, sum(w) AS w, sum(s) AS s FROM {cells} GROUP BY node, feature, bin
),
run AS (
  SELECT node, feature, bin,
         sum(n) OVER upto AS ln, sum(w) OVER upto AS lw, sum(s) OVER upto AS ls,
         sum(n) OVER whole AS an, sum(w) OVER whole AS aw, sum(s) OVER whole AS as
  FROM summed
  WINDOW upto AS (PARTITION BY node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING),
         whole AS (PARTITION BY node, feature)
),
gained AS (
  SELECT *, CASE WHEN ln >= :least AND an - ln >= :least
                 THEN round(ls * ls / lw + (as - ls) * (as - ls) / (aw - lw) - as * as / aw, 6) END AS gain
  FROM run
)
SELECT node, max(struct(an, aw, as)) AS all,
       max(CASE WHEN gain > 0 THEN struct(gain, -feature AS f, -bin AS c, ln, lw, ls) END) AS best
FROM gained GROUP BY node
"""


def grow(
    rows: DataFrame, growing: list[Growing], targets: Targets, features: int, bins: int, least_leaf: int = 1
) -> list[Tree]:
    """Grow all trees to their ends over ``rows`` (see ``BINNED``, and what ``targets`` reads).

    The rows of a growing tree's root, set beforehand, are an upper bound of its rows.
    """
    spark = rows.sparkSession
    frontier = [(m, 0) for m in range(len(growing))]
    while frontier:
        small = [x for x in frontier if growing[x[0]].nodes[x[1]].rows <= LOCAL]
        large = [x for x in frontier if growing[x[0]].nodes[x[1]].rows > LOCAL]
        for at in range(0, len(large), OPEN):
            wanted = large[at : at + OPEN]
            task = _cells(_packed(growing, wanted), targets, features, bins, len(wanted))
            for m, i in wanted:
                growing[m].nodes[i].known = True
            # One row per open node.
            for found in best_cuts(rows.mapInArrow(task, CELL), least_leaf).collect():
                m, i = wanted[found["node"]]
                node, best = growing[m].nodes[i], found["best"]
                node.rows, node.weight, node.total = found["all"]
                if best:
                    node.best = (best["gain"], -best["f"], -best["c"], *best[3:])
        for at in range(0, len(small), OPEN):
            wanted = small[at : at + OPEN]
            sent = rows.mapInArrow(_rows_of(_packed(growing, wanted), targets, features), ROW)
            numbers = {
                k: (growing[m].leaves, growing[m].depth, growing[m].least, growing[m].nodes[i].depth)
                for k, (m, i) in enumerate(wanted)
            }
            for m, i in wanted:
                growing[m].nodes[i].known = True
            tasks = min(len(wanted), int(spark.conf.get("spark.sql.shuffle.partitions")))
            branches = sent.repartition(tasks, "node").groupBy("node").applyInArrow(
                _branches(numbers, features, bins, least_leaf), BRANCH
            )
            for found in branches.collect():
                _graft(growing[wanted[found["node"]][0]], wanted[found["node"]][1], found)
        frontier = [(m, i) for m, g in enumerate(growing) for i in g.select()[1]]
    return [g.finished() for g in growing]


def edges_of(rows: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of the bins of every input, from quantiles of its values; one pass."""
    shares = [float(q) for q in np.arange(1, bins) / bins]
    found = rows.agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, 10 * bins).alias(f"_{i}") for i, c in enumerate(inputs)]
    ).first()
    return [np.unique(np.array(q or [], float)) for q in found]


def binned(
    rows: DataFrame, inputs: Sequence[str], edges: Sequence[np.ndarray], *others
) -> DataFrame:
    """The named columns and ``x``: a byte per input, the number of its bin. Missing ones count as
    lowest."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            k = batch.num_columns - len(inputs)
            out = np.zeros((batch.num_rows, len(inputs)), np.uint8)
            for i, ends in enumerate(edges):
                values = batch.column(k + i).to_numpy(zero_copy_only=False)
                out[:, i] = np.where(np.isnan(values), 0, np.searchsorted(ends, values, "left"))
            raw = [line.tobytes() for line in out]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:k], pa.array(raw, pa.binary())], names=[*batch.schema.names[:k], "x"]
            )

    taken = rows.select(*others, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(inputs)])
    kept = taken.schema.fields[: len(taken.columns) - len(inputs)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "x binary"])
    return taken.mapInArrow(batches, schema)


# Weights -------------------------------------------------------------------------------

# The finaliser of a 64-bit mixing generator.
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)


def uniform(h: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A number below 1 for every pair of a row's hash and a number."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64)[:, None] ^ ((of.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX[2]))
        for shift, factor in ((30, MIX[0]), (27, MIX[1])):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(float) / 2.0**53


def bootstrap(h: np.ndarray, trees: np.ndarray) -> np.ndarray:
    """How often each row is drawn for each tree: Poisson numbers of mean 1, which a sample of the
    rows' own number tends to, without counting them."""
    ends = np.cumsum(np.exp(-1) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320.0]))
    return np.searchsorted(ends, uniform(h, trees).ravel(), "right").reshape(len(h), -1).astype(float)
