"""Boosted trees with logistic loss, grown from sums of gradients per bin.

Every feature is cut once into bins of about equal rows, copies of a value together. A level of
a tree needs the sums of gradients and hessians per (model, node, feature, bin); from these come
the splits, and the leaves' weights follow from the sums on both sides. Gradients are whole
numbers, in units of 2**-28, so sums are exact and the trees don't depend on how rows are dealt out.

Sums are taken in two places, with the same result. A table that fits a task is whole there, so the
task goes on from level to level and tree to tree: one task per configuration, side by side. The
rows of a larger table stay in their tasks; each level of all configurations is one job that adds
up the tasks' sums, and the driver sees a number per bin and node. Margins are written
every few trees, so that a task has only the latest trees to apply and a lost executor costs little.

The objective is the second-order one: a leaf weighs -G / (H + 1), a split gains
GL**2 / (HL + 1) + GR**2 / (HR + 1) - G**2 / (H + 1) and must gain more than 1e-6 and at
least ``gamma``, and each side must have hessians of at least ``min_child_weight``. Rows are drawn
per tree by a digest of the row, columns by a digest of their place. The first margin is one Newton step
for all rows. Missing values go to the side that gains more, to the right if nothing is gained.
Cases: null and NaN features are missing; rows without a label are left out; rows of one
class give trees of one leaf; an empty table is an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.operators.ranking import bucket_levels, running_before, value_counts
from tremorlake.session import cut_lineage

# What runs in tasks travels with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = float(1 << 28)
# Bins per feature; the last one holds missing values.
BINS, MISSING = 256, 255
PENALTY = 1.0
LEAST_GAIN = 1e-6
# Rows that one task holds; trees between two writings of the margins.
TASK_ROWS = 200_000
WRITTEN_EVERY = 20

NODES = (
    "model int, tree int, node int, feature int, cut int, missing_left boolean, value double, gain double, cover double"
)
_CELLS = "model int, node int, feature int, bin int, g bigint, h bigint"


def _mixed(x):
    """A 64-bit finaliser over an array."""
    x = x.copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@dataclass
class Tree:
    """Nodes in heap order: the children of n are 2n + 1 and 2n + 2; a leaf has no feature."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def place(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node each row has come to after so many levels."""
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(levels):
            feature = self.feature[node]
            at = bins[rows, feature]
            left = np.where(at == MISSING, self.missing_left[node], at < self.cut[node])
            node = np.where(feature >= 0, 2 * node + 2 - left, node)
        return node


@dataclass
class Growth:
    """One configuration: its finished trees, and the tree that is being grown level by level."""

    params: object
    base: float
    features: int
    seed: int
    trees: list[Tree] = field(default_factory=list)
    tree: Tree | None = None
    level: int = 0

    def __post_init__(self):
        self.tree = self.tree or Tree.empty(self.params.max_depth)

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.params.n_estimators

    def _digest(self, purpose: int) -> np.uint64:
        one = np.array([len(self.trees) + (self.seed << 32) + (purpose << 48)], np.uint64)
        return _mixed(one + np.uint64(0x9E3779B97F4A7C15))[0]

    def drawn(self, keys: np.ndarray) -> np.ndarray:
        """Which rows this tree is grown on."""
        if self.params.subsample >= 1.0:
            return np.ones(len(keys), bool)
        return _mixed(keys ^ self._digest(1)) < np.uint64(int(self.params.subsample * 2.0**64))

    def columns(self) -> np.ndarray:
        """The features this tree may split on, in order."""
        n = max(1, int(self.features * self.params.colsample))
        order = np.argsort(_mixed(np.arange(self.features, dtype=np.uint64) ^ self._digest(2)), kind="stable")
        return np.sort(order[:n])

    def apply(self, sums: np.ndarray) -> None:
        """Take the sums (2, nodes of the level, features, bins) and go on to the next level or tree."""
        depth, rate = self.params.max_depth, self.params.learning_rate
        first, columns = 2**self.level - 1, self.columns()
        g, h = sums[:, :, columns, :].astype(float) / UNIT
        whole = g[:, 0].sum(1), h[:, 0].sum(1)
        if self.level == 0:
            self._set(0, whole[0][0], whole[1][0], rate)
        split = False
        for n, (feature, cut, missing_left, gain, left) in best_splits(g, h, self.params).items():
            at = first + n
            tree, split = self.tree, True
            tree.feature[at], tree.cut[at], tree.missing_left[at], tree.gain[at] = columns[feature], cut, missing_left, gain
            self._set(2 * at + 1, *left, rate)
            self._set(2 * at + 2, whole[0][n] - left[0], whole[1][n] - left[1], rate)
        self.level += 1
        if not split or self.level == depth:
            self.trees.append(self.tree)
            self.tree, self.level = Tree.empty(depth), 0

    def _set(self, node: int, g: float, h: float, rate: float) -> None:
        self.tree.value[node], self.tree.cover[node] = -g / (h + PENALTY) * rate, h


def best_splits(g: np.ndarray, h: np.ndarray, params) -> dict[int, tuple]:
    """Per node of a level that is worth a split: feature, cut, side of missing values, gain, sums on the left.

    ``g`` and ``h`` have a place per (node, feature, bin). Ties go to the first feature, then to the lowest cut.
    """

    def score(x, y):
        return x * x / (y + PENALTY)

    whole_g, whole_h = g.sum(2)[..., None, None], h.sum(2)[..., None, None]
    missing = np.stack([np.zeros(g.shape[:2]), np.ones(g.shape[:2])], -1)[..., None, :]
    left_g = np.cumsum(g[..., :MISSING], 2)[..., None] + missing * g[..., MISSING, None, None]
    left_h = np.cumsum(h[..., :MISSING], 2)[..., None] + missing * h[..., MISSING, None, None]
    right_g, right_h = whole_g - left_g, whole_h - left_h
    gain = score(left_g, left_h) + score(right_g, right_h) - score(whole_g, whole_h)
    least = max(params.min_child_weight, 1.0 / UNIT)
    gain[(left_h < least) | (right_h < least)] = 0.0
    flat = gain.reshape(len(gain), -1)
    found = {}
    for n, at in enumerate(flat.argmax(1)):
        if flat[n, at] > LEAST_GAIN and flat[n, at] >= params.gamma:
            feature, cut, side = np.unravel_index(at, gain.shape[1:])
            left = left_g[n, feature, cut, side], left_h[n, feature, cut, side]
            found[n] = (int(feature), int(cut) + 1, bool(side), float(flat[n, at]), left)
    return found


class Rows:
    """Some rows in a task: bins, labels, digests, and their margins as far as they are known."""

    def __init__(self, keys, bins, labels, margin, trees: int = 0):
        self.keys, self.bins, self.labels, self.margin, self.trees = keys, bins, labels, margin, trees

    @classmethod
    def of(cls, batch, features: int, margin: np.ndarray, trees: int = 0) -> Rows:
        bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
        keys = batch.column("key").to_numpy().view(np.uint64)
        return cls(keys, bins, batch.column("y").to_numpy(), margin, trees)

    def catch_up(self, growth: Growth) -> None:
        for tree in growth.trees[self.trees :]:
            self.margin = self.margin + tree.value[tree.place(self.bins, growth.params.max_depth)]
        self.trees = len(growth.trees)

    def sums(self, growth: Growth) -> np.ndarray:
        """Exact sums of gradients and hessians per (node of the level, feature, bin)."""
        self.catch_up(growth)
        chance = 1.0 / (1.0 + np.exp(-self.margin))
        drawn = growth.drawn(self.keys)
        g = np.rint((chance - self.labels) * UNIT) * drawn
        h = np.rint(chance * (1.0 - chance) * UNIT) * drawn
        width, first = 2**growth.level, 2**growth.level - 1
        node = growth.tree.place(self.bins, growth.level) - first
        in_level = np.nonzero(node >= 0)[0]
        bins = self.bins[in_level]
        cells = (node[in_level][:, None] * growth.features + np.arange(growth.features)) * BINS + bins
        size = width * growth.features * BINS
        # Whole numbers below 2**53: sums of doubles are exact.
        parts = [np.bincount(cells.ravel(), np.repeat(x[in_level], growth.features), size) for x in (g, h)]
        return np.stack(parts).astype(np.int64).reshape(2, width, growth.features, BINS)


def _node_rows(model: int, trees: list[Tree]) -> pa.Table:
    """Rows of NODES: the nodes that a root leads to."""
    columns = [[] for _ in range(9)]
    for number, tree in enumerate(trees):
        inner = tree.feature >= 0
        real = [0] + [c for n in np.nonzero(inner)[0].tolist() for c in (2 * n + 1, 2 * n + 2)]
        for n in sorted(real):
            row = (model, number, n, tree.feature[n], tree.cut[n], tree.missing_left[n], tree.value[n], tree.gain[n], tree.cover[n])
            for column, value in zip(columns, row):
                column.append(value)
    kinds = [pa.int32()] * 5 + [pa.bool_()] + [pa.float64()] * 3
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [n.split()[0] for n in NODES.split(", ")])


def bin_edges(rows: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Inner edges of each feature's bins: the least value of every bin but the first.

    A value's bin follows from the rows with smaller values, so copies stay together. The order is cut into levels,
    and a few hundred numbers per feature reach the driver.
    """
    counts = cut_lineage(value_counts(rows, features), "feature-values")
    bounds = counts.groupBy("feature").agg(F.min("value").alias("_low"), F.max("value").alias("_high"), F.sum("n").alias("_all"))
    width = F.when(F.col("_high") > F.col("_low"), F.col("_high") - F.col("_low")).otherwise(1.0)
    levels = bucket_levels(F.col("value"), F.col("_low"), F.col("_low") + width)
    # One row per feature.
    levelled = cut_lineage(counts.join(F.broadcast(bounds), "feature").withColumns(levels), "levelled-values")
    before = running_before(levelled, ["n"], ["value"], ["feature"], ["coarse", "fine"])
    place = F.floor(F.col("n_before") * (MISSING - 1) / F.col("_all"))
    edges = before.groupBy("feature", place.alias("place")).agg(F.min("value").alias("edge"))
    found = {f: [] for f in features}
    for row in edges.orderBy("feature", "place").collect():
        found[row["feature"]].append(row["edge"])
    return [np.array(found[f][1:]) for f in features]


def binned(rows: DataFrame, edges: list[np.ndarray], features: Sequence[str], label: str) -> DataFrame:
    """``key, y, bins``: a digest of the row, its label, and a byte per feature."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty((batch.num_rows, len(edges)), np.uint8)
            for n, edge in enumerate(edges):
                values = batch.column(n + 2).to_numpy(zero_copy_only=False).astype(float)
                out[:, n] = np.where(np.isnan(values), MISSING, np.searchsorted(edge, values, side="right"))
            packed = pa.array([r.tobytes() for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["key", "y", "bins"])

    numbers = [F.col(f).cast("double").alias(f) for f in features]
    kept = rows.filter(F.col(label).isNotNull())
    plain = kept.select(F.xxhash64(*rows.columns).alias("key"), F.col(label).cast("int").alias("y"), *numbers)
    return plain.mapInArrow(cut, "key bigint, y int, bins binary")


def _in_tasks(stored: DataFrame, growths: list[Growth]) -> pa.Table:
    """All trees of every configuration, each grown in one task that holds all rows."""

    def grow(group: pa.Table) -> pa.Table:
        model = group.column("model")[0].as_py()
        growth = growths[model]
        rows = Rows.of(group, growth.features, np.full(group.num_rows, growth.base))
        while not growth.done:
            growth.apply(rows.sums(growth))
        return _node_rows(model, growth.trees)

    numbered = stored.withColumn("model", F.explode(F.array(*[F.lit(n) for n in range(len(growths))])))
    return numbered.groupBy("model").applyInArrow(grow, NODES).toArrow()


def _level_by_level(stored: DataFrame, growths: list[Growth]) -> pa.Table:
    """The same trees from rows that stay in their tasks: one job per level for all configurations."""
    features = growths[0].features
    written = [0] * len(growths)
    rows = stored.withColumn("margins", F.array(*[F.lit(g.base) for g in growths]))

    def caught_up(batch, known: list[int]) -> list[Rows]:
        margins = batch.column("margins").flatten().to_numpy().reshape(-1, len(growths))
        return [Rows.of(batch, features, margins[:, n].copy(), trees) for n, trees in enumerate(known)]

    while not all(g.done for g in growths):
        if max(len(g.trees) - w for g, w in zip(growths, written)) >= WRITTEN_EVERY:

            def write(batches, known=tuple(written)):
                for batch in batches:
                    every = caught_up(batch, known)
                    for some, growth in zip(every, growths):
                        some.catch_up(growth)
                    margins = np.stack([some.margin for some in every], 1)
                    offsets = pa.array(np.arange(batch.num_rows + 1) * len(growths), pa.int32())
                    lists = pa.ListArray.from_arrays(offsets, pa.array(margins.ravel()))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "y", "bins")), lists], batch.schema.names)

            rows = cut_lineage(rows.mapInArrow(write, rows.schema), "margins")
            written = [len(g.trees) for g in growths]

        def measure(batches, known=tuple(written)):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for model, some in enumerate(caught_up(batch, known)):
                    if not growths[model].done:
                        found = some.sums(growths[model])
                        total[model] = total[model] + found if model in total else found
            for model, (g, h) in total.items():
                node, feature, place = np.nonzero((g != 0) | (h != 0))
                columns = [np.full(len(node), model), node, feature, place]
                arrays = [pa.array(c, pa.int32()) for c in columns] + [pa.array(x[node, feature, place]) for x in (g, h)]
                yield pa.RecordBatch.from_arrays(arrays, [n.split()[0] for n in _CELLS.split(", ")])

        cells = rows.mapInArrow(measure, _CELLS).groupBy("model", "node", "feature", "bin")
        found = cells.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        at = [found.column(c).to_numpy() for c in ("model", "node", "feature", "bin", "g", "h")]
        for model, growth in enumerate(growths):
            if not growth.done:
                mine = [x[at[0] == model] for x in at]
                sums = np.zeros((2, 2**growth.level, features, BINS), np.int64)
                sums[0, mine[1], mine[2], mine[3]], sums[1, mine[1], mine[2], mine[3]] = mine[4], mine[5]
                growth.apply(sums)
    return pa.concat_tables([_node_rows(n, g.trees) for n, g in enumerate(growths)])


def grow_forests(
    train: DataFrame, params: Sequence, features: Sequence[str], label: str, seed: int, task_rows: int = TASK_ROWS
) -> tuple[pa.Table, float, list[np.ndarray]]:
    """Rows of NODES for every configuration, the first margin, and the bins' edges."""
    known = cut_lineage(train, "training-rows")
    edges = bin_edges(known.filter(F.col(label).isNotNull()), features)
    stored = cut_lineage(binned(known, edges, features, label), "binned-rows")
    n, positive = stored.agg(F.count(F.lit(1)), F.count_if(F.col("y") == 1)).first()
    if not n:
        raise ValueError("there are no rows to learn from")
    # One Newton step from a chance of one half.
    base = (positive - n / 2) / (n / 4)
    growths = [Growth(p, base, len(features), seed) for p in params]
    grown = _in_tasks(stored, growths) if n <= task_rows else _level_by_level(stored, growths)
    return grown, base, edges
