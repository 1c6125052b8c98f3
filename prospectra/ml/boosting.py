"""Boosted trees of second order, grown level by level or leaf by leaf, as Spark jobs.

Values of the inputs become bins. Per tree, a job adds up gradient and hessian of the log loss by node,
input and bin: a task sends one histogram, whose size does not follow its rows, and a sum by cell joins
them. The best split of a node follows from its histogram on the driver. Leaves are split in the order
of their gain; a job also looks at children of leaves that may be split next, so that a tree takes as many
jobs as it is deep, not as it has leaves, and is the same as if they were split one by one. Gradients are
whole multiples of a small unit, so sums, and with them the trees, do not depend on the order of tasks.

The result is Spark's own boosted model: it scores, saves and explains like any other.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from prospectra.functions import named
from prospectra.operators.quantiles import column_quantiles
from prospectra.sources.scratch import materialize, new_scratch_path, release

#: Cells of the histograms of one job, 24 bytes each; nodes beyond it wait for the next job.
MAX_CELLS = 1_000_000
#: Trees after which the rows are written anew with their score so far.
REFRESH = 8
#: Gain below which a split only follows rounding.
_LEAST_GAIN = 1e-6
#: Least curvature that is divided by.
_TINY = 1e-12


@dataclass(frozen=True)
class Growth:
    """How trees grow. Zero depth or leaves: no bound. `base_score` is a probability, None the rate of the rows."""

    trees: int = 100
    rate: float = 0.1
    max_depth: int = 0
    max_leaves: int = 0
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    min_hessian: float = 0.0
    min_rows: int = 1
    row_share: float = 1.0
    column_share: float = 1.0
    max_bins: int = 64
    seed: int = 42
    base_score: float | None = None

    def __post_init__(self):
        if not 2 <= self.max_bins <= 256:
            raise ValueError(f"max_bins {self.max_bins}: must be 2 to 256")
        for share in (self.row_share, self.column_share):
            if not 0.0 < share <= 1.0:
                raise ValueError(f"share {share}: must be above 0 and at most 1")

    def pull(self, g):
        """The gradient beyond what the L1 penalty takes."""
        return np.sign(g) * np.maximum(np.abs(g) - self.l1, 0.0)

    def score(self, g, h):
        return self.pull(g) ** 2 / np.maximum(h + self.l2, _TINY)

    def value(self, g: float, h: float) -> float:
        return float(-self.rate * self.pull(g) / max(h + self.l2, _TINY))


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    bin: int
    left: tuple[float, float, int]
    right: tuple[float, float, int]


class Tree:
    """Nodes in the order of their creation; also those whose parent is not split in the end."""

    def __init__(self):
        self.sums: list[tuple[float, float, int]] = [(0.0, 0.0, 0)]
        self.depth, self.left, self.right = [0], [-1], [-1]
        self.best: list[Split | None] = [None]
        self.known = [False]
        self.chosen: list[int] = []

    def _children(self, node: int, growth: Growth) -> list[int]:
        if self.left[node] < 0:
            split, depth = self.best[node], self.depth[node] + 1
            for sums in (split.left, split.right):
                _, h, n = sums
                last = depth == growth.max_depth or n < 2 * growth.min_rows or h < 2 * growth.min_hessian
                self.sums.append(sums)
                self.depth.append(depth)
                self.left.append(-1)
                self.right.append(-1)
                self.best.append(None)
                self.known.append(last)
            self.left[node], self.right[node] = len(self.sums) - 2, len(self.sums) - 1
        return [self.left[node], self.right[node]]

    def advance(self, growth: Growth) -> list[int]:
        """Split leaves by gain; the nodes whose histograms must be known before these splits are certain.

        A leaf whose children are not known yet is split as if these gained nothing. Whatever they gain, the
        leaves split in the end are among those split here and what comes below the unknown children.
        """
        self.chosen, wanted = [], []
        ready = [(-self.best[0].gain, 0)] if self.best[0] else []
        while ready and (not growth.max_leaves or len(self.chosen) + 1 < growth.max_leaves):
            _, node = heapq.heappop(ready)
            self.chosen.append(node)
            for child in self._children(node, growth):
                if not self.known[child]:
                    wanted.append(child)
                elif self.best[child]:
                    heapq.heappush(ready, (-self.best[child].gain, child))
        last = growth.max_leaves and len(self.chosen) + 1 == growth.max_leaves
        if last and wanted and min(wanted) == self.left[self.chosen[-1]]:
            return []  # only children of the last split are unknown, and none of them will be split
        return wanted

    def arrays(self, only_chosen: bool) -> "Routes":
        chosen = set(self.chosen)
        split = [self.left[i] >= 0 and (not only_chosen or i in chosen) for i in range(len(self.sums))]
        return Routes(
            np.array([self.best[i].feature if s else -1 for i, s in enumerate(split)]),
            np.array([self.best[i].bin if s else 0 for i, s in enumerate(split)]),
            np.array(self.left),
            np.array(self.right),
            max(self.depth),
        )


@dataclass(frozen=True)
class Routes:
    """A tree as tasks need it."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: int

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(self.depth):
            feature = self.feature[at]
            down = np.where(bins[rows, np.maximum(feature, 0)] <= self.bin[at], self.left[at], self.right[at])
            at = np.where(feature >= 0, down, at)
        return at


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _bins(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def cut_points(inputs: DataFrame, width: int, max_bins: int) -> list[np.ndarray]:
    """Upper borders of all bins but the last, for every element of the array column `x`.

    An input of at most `max_bins` values gets a bin for each, with borders half-way between them; others are cut
    at quantiles. NaN is not a value; it goes to the last bin.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray | None] = [np.empty(0)] * width
        for batch in batches:
            if batch.num_rows:
                values = _matrix(batch.column(0))
                for i, known in enumerate(held):
                    if known is not None:
                        known = np.union1d(known, values[:, i][~np.isnan(values[:, i])])
                        held[i] = known if len(known) <= max_bins else None
        found = [(i, v) for i, known in enumerate(held) for v in ([None] if known is None else known.tolist())]
        columns = [pa.array([i for i, _ in found], pa.int32()), pa.array([v for _, v in found], pa.float64())]
        yield pa.record_batch(columns, ["feature", "value"])

    values = materialize(inputs.select("x").mapInArrow(distinct, "feature int, value double").distinct(), "values")
    sizes = values.groupBy("feature").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("many"))
    few = sizes.where((F.col("many") == 0) & (F.col("n") <= max_bins)).select("feature")
    cuts: dict[int, np.ndarray] = {}
    for row in values.join(few, "feature").groupBy("feature").agg(F.sort_array(F.collect_list("value"))).collect():
        held = np.array(row[1])
        cuts[row[0]] = (held[:-1] + held[1:]) / 2
    many = [row[0] for row in sizes.where((F.col("many") > 0) | (F.col("n") > max_bins)).collect()]
    if many:
        wide = inputs.select([F.get("x", F.lit(i)).alias(str(i)) for i in sorted(many)])
        shares = [k / max_bins for k in range(1, max_bins)]
        for row in column_quantiles(wide, wide.columns, shares).collect():
            cuts[int(row[0])] = np.unique(np.array(row[1]))
    return [cuts.get(i, np.empty(0)) for i in range(width)]


def _binned(inputs: DataFrame, cuts: list[np.ndarray], margin: float) -> DataFrame:
    """`key`, `y`, `w`, `margin`, `bins`: a byte per input."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(3)) if batch.num_rows else np.empty((0, len(cuts)))
            bins = np.empty(values.shape, np.uint8)
            for i, borders in enumerate(cuts):
                bins[:, i] = np.searchsorted(borders, values[:, i], side="left")
            columns = [*batch.columns[:3], pa.array(np.full(len(bins), margin)), pa.array([row.tobytes() for row in bins], pa.binary())]
            yield pa.record_batch(columns, ["key", "y", "w", "margin", "bins"])

    keyed = inputs.select(F.monotonically_increasing_id().alias("key"), "y", "w", "x")
    return keyed.mapInArrow(cut, "key bigint, y double, w double, margin double, bins binary")


def _margin(batch: pa.RecordBatch, bins: np.ndarray, done: Sequence[tuple[Routes, np.ndarray]]) -> np.ndarray:
    margin = batch.column("margin").to_numpy().copy()
    for routes, values in done:
        margin += values[routes.node_of(bins)]
    return margin


def _moved(state: DataFrame, done: Sequence[tuple[Routes, np.ndarray]]) -> DataFrame:
    """The rows with `margin` after the trees `done`."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margin = pa.array(_margin(batch, _bins(batch.column("bins")), done))
                yield batch.set_column(3, "margin", margin)

    return state.mapInArrow(move, state.schema)


def _drawn(keys: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Which rows a tree sees; the same whenever they are read."""
    mixed = (keys.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(11)).astype(np.float64) < share * 2.0**53


class _Booster:
    def __init__(self, growth: Growth, cuts: list[np.ndarray], unit: float):
        self.growth, self.cuts, self.unit = growth, cuts, unit
        self.columns = np.arange(len(cuts))

    def draw_columns(self, tree: int) -> None:
        """Inputs of a tree; one without two values cannot be split and takes no cells."""
        usable = np.array([i for i, borders in enumerate(self.cuts) if len(borders)], np.int64)
        n = max(1, int(self.growth.column_share * len(usable))) if len(usable) else 0
        rng = np.random.default_rng([self.growth.seed, tree])
        self.columns = usable if n == len(usable) else np.sort(rng.choice(usable, n, replace=False))
        sizes = np.array([len(self.cuts[i]) + 1 for i in self.columns], np.int64)
        self.offsets = np.cumsum(sizes) - sizes
        self.last = self.offsets + sizes - 1
        self.cells = int(sizes.sum())

    def histograms(self, state: DataFrame, done, partial: Routes, wanted: list[int], draw: int) -> np.ndarray:
        """Gradient, hessian and rows by wanted node and cell."""
        growth, columns, offsets, cells, unit = self.growth, self.columns, self.offsets, self.cells, self.unit
        slots = np.full(len(partial.feature), -1)
        slots[wanted] = np.arange(len(wanted))
        size = len(wanted) * cells

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((3, size), np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                bins = _bins(batch.column("bins"))
                slot = slots[partial.node_of(bins)]
                seen = slot >= 0
                if growth.row_share < 1:
                    seen &= _drawn(batch.column("key").to_numpy(), growth.row_share, draw)
                p = 1 / (1 + np.exp(-_margin(batch, bins, done)))[seen]
                w, y = batch.column("w").to_numpy()[seen], batch.column("y").to_numpy()[seen]
                cell = ((slot[seen] * cells)[:, None] + offsets + bins[seen][:, columns]).ravel()
                for k, value in enumerate((np.rint(w * (p - y) / unit), np.rint(w * p * (1 - p) / unit), np.ones(len(p)))):
                    sums[k] += np.bincount(cell, np.repeat(value, len(columns)), size).astype(np.int64)
            met = np.flatnonzero(sums[2])
            yield pa.record_batch([pa.array(met), *(pa.array(s[met]) for s in sums)], ["cell", "g", "h", "n"])

        parts = state.mapInArrow(count, "cell bigint, g bigint, h bigint, n bigint")
        table = parts.groupBy("cell").agg(*(F.sum(c).alias(c) for c in "ghn")).toArrow()
        found = np.zeros((3, size))
        for k, c in enumerate("ghn"):
            found[k, table.column("cell").to_numpy()] = table.column(c).to_numpy()
        found[:2] *= unit
        return found.reshape(3, len(wanted), cells)

    def best_split(self, sums: np.ndarray) -> tuple[tuple[float, float, int], Split | None]:
        """Sums of a node and its best split; of equal ones the first input's, at its lowest border."""
        g, h, n = total = sums[:, : self.last[0] + 1].sum(axis=1)
        upto = np.cumsum(sums, axis=1)
        before = np.where(self.offsets > 0, upto[:, self.offsets - 1], 0.0)
        left = upto - np.repeat(before, self.last - self.offsets + 1, axis=1)
        right = total[:, None] - left
        growth = self.growth
        gain = growth.score(left[0], left[1]) + growth.score(right[0], right[1]) - growth.score(g, h)
        allowed = (np.minimum(left[2], right[2]) >= max(growth.min_rows, 1)) & (np.minimum(left[1], right[1]) >= growth.min_hessian)
        allowed[self.last] = False
        gain = np.where(allowed, gain, -np.inf)
        at = int(np.argmax(gain))
        node = (float(g), float(h), int(n))
        if not gain[at] > max(growth.min_gain, _LEAST_GAIN):
            return node, None
        k = int(np.searchsorted(self.offsets, at, side="right")) - 1
        sides = [(float(s[0, at]), float(s[1, at]), int(s[2, at])) for s in (left, right)]
        return node, Split(float(gain[at]), int(self.columns[k]), at - int(self.offsets[k]), *sides)

    def grow(self, state: DataFrame, done, number: int) -> Tree:
        self.draw_columns(number)
        tree, draw = Tree(), self.growth.seed * 1_000_003 + number
        wanted = [0] if self.cells else []
        while wanted:
            routes, step = tree.arrays(only_chosen=False), max(1, MAX_CELLS // self.cells)
            for start in range(0, len(wanted), step):
                some = wanted[start : start + step]
                found = self.histograms(state, done, routes, some, draw)
                for place, node in enumerate(some):
                    tree.sums[node], tree.best[node] = self.best_split(found[:, place])
                    tree.known[node] = True
            wanted = tree.advance(self.growth)
        return tree


def fit_boosted(rows: DataFrame, label: str, features: str, weight: str, growth: Growth) -> GBTClassificationModel:
    """A boosted model of the 0/1 `label` by the vector column `features`, rows weighted by `weight`.

    A table without rows is refused. Inputs with one value, or none, are never split.
    """
    spark = rows.sparkSession
    inputs = rows.select(
        named(label).cast("double").alias("y"), named(weight).cast("double").alias("w"), vector_to_array(named(features)).alias("x")
    )
    total = inputs.agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy"), F.max(F.size("x")).alias("width")).first()
    if not total["w"]:
        raise ValueError("no rows to train on")
    cuts = cut_points(inputs, total["width"], growth.max_bins)
    share = total["wy"] / total["w"] if growth.base_score is None else growth.base_score
    share = min(max(share, 1e-9), 1 - 1e-9)
    base = math.log(share / (1 - share))
    # Sums of all rows fit into 62 bits.
    booster = _Booster(growth, cuts, 2.0 ** -min(30, 62 - math.ceil(math.log2(total["w"] + 1))))
    trees: list[Tree] = []
    path = new_scratch_path(spark, "binned")
    state = materialize(_binned(inputs, cuts, base), "binned", path).persist(StorageLevel.MEMORY_AND_DISK)
    done: list[tuple[Routes, np.ndarray]] = []
    try:
        for number in range(growth.trees):
            if len(done) == REFRESH:
                after = new_scratch_path(spark, "binned")
                moved = materialize(_moved(state, done), "binned", after).persist(StorageLevel.MEMORY_AND_DISK)
                state.unpersist()
                release(spark, path)
                state, path, done = moved, after, []
            tree = booster.grow(state, done, number)
            trees.append(tree)
            done.append((tree.arrays(only_chosen=True), np.array([growth.value(g, h) for g, h, _ in tree.sums])))
    finally:
        state.unpersist()
        release(spark, path)
    return _as_spark_model(spark, trees, base, cuts, growth)


def _as_spark_model(
    spark: SparkSession, trees: list[Tree], base: float, cuts: list[np.ndarray], growth: Growth
) -> GBTClassificationModel:
    """Spark's boosted model of the same scores: its probability is that of twice the sum of its trees.

    The score that all rows start from is a tree of one leaf. Gains are stored per unit of curvature, by which
    Spark multiplies them again where it adds up importances.
    """
    ml, calculator = spark._jvm.org.apache.spark.ml, spark._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def array(kind, values):
        made = spark._sc._gateway.new_array(kind, len(values))
        for i, value in enumerate(values):
            made[i] = value
        return made

    def stats(h: float, n: int):
        return calculator(array(spark._jvm.double, [float(h), 0.0, 0.0]), n)

    def root(tree: Tree):
        made, chosen = {}, set(tree.chosen)
        for i in reversed(range(len(tree.sums))):  # children come after their parents
            g, h, n = tree.sums[i]
            value = growth.value(g, h) / 2
            if i in chosen:
                split = tree.best[i]
                border = ml.tree.ContinuousSplit(split.feature, float(cuts[split.feature][split.bin]))
                sides = made[tree.left[i]], made[tree.right[i]]
                made[i] = ml.tree.InternalNode(value, 0.0, split.gain / max(h, _TINY), *sides, border, stats(h, n))
            else:
                made[i] = ml.tree.LeafNode(value, 0.0, stats(h, n))
        return made[0]

    width = len(cuts)
    roots = [ml.tree.LeafNode(base / 2, 0.0, stats(0.0, 0)), *(root(tree) for tree in trees)]
    models = [ml.regression.DecisionTreeRegressionModel(f"tree_{i}", node, width) for i, node in enumerate(roots)]
    uid = Identifiable().uid.replace("Identifiable", "SecondOrderBoosting")
    java = ml.classification.GBTClassificationModel(
        uid, array(ml.regression.DecisionTreeRegressionModel, models), array(spark._jvm.double, [1.0] * len(models)), width, 2
    )
    return GBTClassificationModel(java)
