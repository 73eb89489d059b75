"""Gradient-boosted trees for training sets of any number of rows.

The trees are those of ``pyspark.ml``'s GBTClassifier: the same sample and candidate thresholds, variance gain, logistic
loss, learning rate, order of features among equal gains and pruning.  What differs is how rows are held and
added up.  The library keeps an object per row and walks all of them for every level of every tree; here a row is binned once and held in
blocks of one or two bytes a feature, and a pass adds up a block's residuals by (node, bins of two features) in numpy.

Residuals are added up as whole multiples of 2^-32, so sums are exact: they do not depend on the order of rows,
blocks or tasks, and equal splits have equal gains.  A task holds one block at a time; the driver gets one histogram
per task.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows of a block.  A block's sums of residuals (below 4) in UNITs stay below 2^53, so float64 adds them exactly.
BLOCK_ROWS = 1 << 16
# Fixed value: a residual of 1.
UNIT = 1 << 32
# Fixed value, as in pyspark.ml: rows sampled for the candidate thresholds.
SPLIT_ROWS = 10_000
# Trees that a pass adds to the kept margins itself, before margins are kept anew.
KEEP_TREES = 4
# A pass has at most a task per this many rows, and at least one per the second.  Between them it follows the cluster's
# cores, which changes no result.
TASK_ROWS = (4 * BLOCK_ROWS, 256 * BLOCK_ROWS)
# Histograms of more tasks than this are added up on the executors.
DRIVER_TASKS = 512
# No bin is beyond this: all rows go left.
NO_BIN = (1 << 16) - 1

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need not have this package


# --- in the tasks --------------------------------------------------------------------------------------------------

def _binned(thresholds: list[np.ndarray], width: int):
    """(label, values) batches -> blocks: bins of two features a number, labels as -1 and 1."""
    def block(codes: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
        if len(codes) % 2:
            codes = np.vstack([codes, np.zeros_like(codes[:1])])
        pairs = codes[0::2] * np.uint16(width) + codes[1::2]
        return pa.RecordBatch.from_arrays([pa.array([pairs.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary())],
                                          ["pairs", "labels"])

    def run(batches):
        codes, labels, held = [], [], 0
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            if b.column(0).null_count or not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("Labels MUST be in {0, 1}")
            if b.column(1).null_count:
                raise ValueError("Vectors MUST NOT be Null")
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), len(thresholds))
            if not np.isfinite(x).all():
                raise ValueError("Vector values MUST NOT be NaN or Infinity")
            codes.append(np.array([np.searchsorted(t, x[:, f]) for f, t in enumerate(thresholds)], dtype=np.uint16))
            labels.append((2 * y - 1).astype(np.int8))
            held += len(y)
            if held >= BLOCK_ROWS:
                c, y = np.hstack(codes), np.concatenate(labels)
                full = held - held % BLOCK_ROWS
                for i in range(0, full, BLOCK_ROWS):
                    yield block(c[:, i:i + BLOCK_ROWS], y[i:i + BLOCK_ROWS])
                codes, labels, held = [c[:, full:]], [y[full:]], held - full
        if held:
            yield block(np.hstack(codes), np.concatenate(labels))
    return run


def _block(row):
    """(pairs, labels, margins) of a written block."""
    y = np.frombuffer(row.labels, np.int8)
    return np.frombuffer(row.pairs, np.uint16).reshape(-1, len(y)), y, np.zeros(len(y))


def _bins(pairs: np.ndarray, width: int):
    """A feature's bins, by the feature's number."""
    kept: dict[int, np.ndarray] = {}

    def of(f: int) -> np.ndarray:
        if f not in kept:
            first = pairs[f // 2] // np.uint16(width)
            kept[f] = pairs[f // 2] - first * np.uint16(width) if f % 2 else first
        return kept[f]
    return of


def _places(bins, splits: list[tuple[int, int]], depth: int, n: int) -> np.ndarray:
    """The node of level ``depth``, counted from the left, that each row is in.  ``splits``: (feature, last bin that goes
    left) of the nodes above, level by level."""
    at, sides = np.zeros(n, np.uint8), []
    for level in range(depth):
        side = [bins(f) > t for f, t in splits[(1 << level) - 1:(2 << level) - 1]]
        for s in reversed(sides):
            side = [left ^ (s & (left ^ right)) for left, right in zip(side[0::2], side[1::2])]
        sides.append(side[0])
        at = (at << 1) | side[0]
    return at


def _with_trees(bins, margins: np.ndarray, trees: list, depth: int) -> np.ndarray:
    for splits, values in trees:
        margins = margins + values.take(_places(bins, splits, depth, len(margins)))
    return margins


def _residuals(y: np.ndarray, margins: np.ndarray | None) -> np.ndarray:
    """Of the logistic loss, in UNITs; of the first tree the labels themselves."""
    if margins is None:
        return y * float(UNIT)
    with np.errstate(over="ignore"):
        return np.rint((4.0 * UNIT * y) / (1.0 + np.exp(2.0 * y * margins)))


def _moved(trees: list, width: int, depth: int):
    def run(block):
        pairs, y, margins = block
        return pairs, y, _with_trees(_bins(pairs, width), margins, trees, depth)
    return run


def _squares(q: np.ndarray, at: np.ndarray, places: int) -> np.ndarray:
    """Exact sums of squares by place."""
    high = np.floor(q / 65536.0)
    low = q - high * 65536.0
    hh, hl, ll = (np.bincount(at, weights=w, minlength=places).astype(np.int64).astype(object) for w in (high * high, high * low, low * low))
    return hh * (1 << 32) + hl * (1 << 17) + ll


def _root_sums(trees: list, second: bool, depth: int, features: int, width: int):
    """Blocks of a task -> [high and low halves of the residuals' sums] by (feature, bin), and the last tree's sums of squared
    residuals by leaf.  ``second``: the last tree is the first of all.  Without trees also [.., rows]: they are the same for all trees."""
    def run(blocks):
        tally, squared = None, np.zeros(1 << depth, dtype=object)
        for pairs, y, margins in blocks:
            if trees:
                bins = _bins(pairs, width)
                margins = _with_trees(bins, margins, trees[:-1], depth)
                at = _places(bins, trees[-1][0], depth, len(y)).astype(np.intp)
                squared = squared + _squares(_residuals(y, None if second else margins), at, 1 << depth)
                q = _residuals(y, margins + trees[-1][1].take(at))
            else:
                q = _residuals(y, None)
            tally = tally or _Tally(len(pairs), 1, width, not trees)
            tally.add(0, pairs, q)
        if tally:
            yield tally.of(features), squared
    return run


def _child_sums(trees: list, splits: list, level: int, wanted: list[int], depth: int, features: int, width: int):
    """Blocks of a task -> [high and low halves of the residuals' sums, rows] by (node, feature, bin) for the nodes ``wanted`` of
    ``level``; only their rows are looked at further."""
    def run(blocks):
        tally = None
        order = np.zeros(1 << level, np.intp)
        order[wanted] = np.arange(len(wanted)) * (width * width)
        for pairs, y, margins in blocks:
            at = _places(_bins(pairs, width), splits, level, len(y))
            some = np.flatnonzero(reduce(np.bitwise_or, [at == w for w in wanted]))
            pairs, y, at = np.stack([p.take(some) for p in pairs]), y.take(some), order.take(at.take(some))
            if trees:
                q = _residuals(y, _with_trees(_bins(pairs, width), margins.take(some), trees, depth))
            else:
                q = _residuals(y, None)
            tally = tally or _Tally(len(pairs), len(wanted), width, True)
            tally.add(at, pairs, q)
        if tally:
            yield tally.of(features), 0
    return run


class _Tally:
    """Sums of residuals, and rows, by (node, bins of two features)."""

    def __init__(self, pairs: int, nodes: int, width: int, rows: bool):
        self.nodes, self.width = nodes, width
        self.parts = [np.zeros((pairs, nodes * width * width), np.int64) for _ in range(1 + rows)]

    def add(self, first, pairs: np.ndarray, q: np.ndarray) -> None:
        """``first``: the first cell of each row's node."""
        cells = self.parts[0].shape[1]
        for p, pair in enumerate(pairs):
            at = pair.astype(np.intp)
            at += first
            self.parts[0][p] += np.bincount(at, weights=q, minlength=cells).astype(np.int64)
            for rows in self.parts[1:]:
                rows[p] += np.bincount(at, minlength=cells)

    def of(self, features: int) -> np.ndarray:
        """By (node, feature, bin)."""
        sums, *rows = (np.stack([a.reshape(-1, self.nodes, self.width, self.width).sum(axis=3 - odd) for odd in (0, 1)], axis=1)
                       .reshape(-1, self.nodes, self.width)[:features].swapaxes(0, 1) for a in self.parts)
        return np.stack([sums >> 32, sums & (UNIT - 1), *rows])


def _both(a, b):
    return a[0] + b[0], a[1] + b[1]


# --- on the driver -------------------------------------------------------------------------------------------------

def feature_thresholds(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Candidate thresholds of one feature from its sampled values: between neighbouring values, with about as many of the
    ``expected`` rows between any two as ``most`` thresholds leave.  As in pyspark.ml, zeros are what the other values leave of
    ``expected``, and a sample that is larger may give a threshold or so more."""
    v, n = np.unique(values[values != 0.0], return_counts=True)
    n = n.astype(float)
    if expected - n.sum() > np.finfo(float).eps * n.sum() * 100:
        at = int(np.searchsorted(v, 0.0))
        v, n = np.insert(v, at, 0.0), np.insert(n, at, expected - n.sum())
    between = (v[:-1] + v[1:]) / 2.0
    if len(between) <= most:
        return between
    stride = expected / (most + 1)
    found, seen, target = [], n[0], stride
    for i in range(1, len(v)):
        before, seen = seen, seen + n[i]
        if abs(before - target) < abs(seen - target):
            found.append(between[i - 1])
            target += stride
    return np.array(found)


def _sampled(rows: DataFrame, n: int, seed: int, least: int) -> tuple[np.ndarray, float]:
    """The values of the rows that pyspark.ml would sample, and how many it expects."""
    spark, share = rows.sparkSession, min(1.0, max(SPLIT_ROWS, least) / n)
    if share < 1.0:
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        drawn = rows._jdf.rdd().sample(False, share, draw)
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    # dense arrays; nulls are refused by the binning
    got = [r.x for r in rows.select(vector_to_array("features").alias("x")).where("x is not null").collect()]
    return np.array(got, dtype=float), share * n


class _Node:
    """A node of a tree in the making: rows, sum of residuals and of their squares (in UNITs); its place in the tree."""

    def __init__(self, place: int, rows: int, total: int):
        self.place, self.rows, self.total, self.squares = place, rows, total, 0
        self.split, self.gain, self.left, self.right, self.tried = None, None, None, None, True

    @property
    def value(self) -> float:
        return self.total / (self.rows * UNIT)

    @property
    def impurity(self) -> float:
        return (self.rows * self.squares - self.total * self.total) / (self.rows * self.rows * UNIT * UNIT)

    def pruned(self) -> None:
        if self.split:
            self.left.pruned()
            self.right.pruned()
            if not self.left.split and not self.right.split and self.left.value == self.right.value:
                self.split = self.left = self.right = None

    def at(self, place: int) -> "_Node":
        node = self
        for bit in bin(place)[3:]:
            node = node.right if bit == "1" else node.left
        return node

    def leaf(self, place: int, depth: int) -> "_Node":
        node = self
        while node.split:
            depth -= 1
            node = node.right if place >> depth & 1 else node.left
        return node


def _best(node: _Node, sums: np.ndarray, rows: np.ndarray, thresholds: list[np.ndarray]) -> None:
    """Gives ``node`` its best split, the first of equal ones, unless none gains."""
    node.tried = False
    best = 0.0
    for f, t in enumerate(thresholds):
        k = len(t)
        if not k:
            continue
        n, s = np.cumsum(rows[f, :k]), np.cumsum(sums[f, :k])
        far = (node.rows - n).astype(object)
        apart = (s * far - (node.total - s) * n.astype(object)).astype(float)      # exact before it is rounded
        both = n.astype(float) * far.astype(float)
        some = both > 0
        if not some.any():
            continue
        node.tried = True
        gain = np.where(some, (apart / node.rows) ** 2 / np.where(some, both, 1.0), -1.0) / float(UNIT) ** 2
        i = int(np.argmax(gain))
        if gain[i] > best:
            best, node.gain, node.split = float(gain[i]), float(gain[i]), (f, i)
            node.left = _Node(2 * node.place, int(n[i]), int(s[i]))
            node.right = _Node(2 * node.place + 1, int(far[i]), int(node.total - s[i]))


class BoostedTrees:
    """Fits what ``settings``, a GBTClassifier, describes: all features continuous, no row weights, no validation rows."""

    def __init__(self, settings: GBTClassifier):
        self.settings = settings

    def fit(self, train: DataFrame) -> GBTClassificationModel:
        g = self.settings
        rows = train.select(F.col(g.getLabelCol()).cast("double").alias("label"), F.col(g.getFeaturesCol()).alias("features"))
        n = rows.count()
        if not n:
            raise ValueError("the training set has no rows")
        values, expected = _sampled(rows, n, g.getSeed(), g.getMaxBins() ** 2)
        most = min(g.getMaxBins(), n) - 1
        thresholds = [feature_thresholds(v, expected, most) for v in values.T]
        cores = 2 * train.sparkSession.sparkContext.defaultParallelism
        grown = self._grown(rows, thresholds, min(-(-n // TASK_ROWS[0]), max(cores, -(-n // TASK_ROWS[1]))))
        return _model(train.sparkSession, g, grown, thresholds)

    def _grown(self, rows: DataFrame, thresholds: list[np.ndarray], tasks: int) -> list[_Node]:
        depth, step = self.settings.getMaxDepth(), self.settings.getStepSize()
        width, features = max([len(t) for t in thresholds], default=0) + 1, len(thresholds)
        binned = rows.select("label", vector_to_array("features").alias("x")).mapInArrow(_binned(thresholds, width), "pairs binary, labels binary")
        kept = binned.rdd.coalesce(tasks).map(_block).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        old = all_rows = None
        roots: list[_Node] = []
        trees: list[tuple] = []      # of the trees that are not in the kept margins: splits and weighted values

        def added(task):
            parts = kept.mapPartitions(task)
            total, squared = parts.treeReduce(_both) if kept.getNumPartitions() > DRIVER_TASKS else reduce(_both, parts.collect())
            total = total.astype(object)
            return total[0] * UNIT + total[1], total[2:].astype(np.int64), squared

        def added_at_root():
            sums, rows, squared = added(_root_sums(trees, len(roots) == 1, depth, features, width))
            if roots:
                _put_squares(roots[-1], squared, depth)
            return sums, rows

        try:
            for m in range(self.settings.getMaxIter()):
                if len(trees) > KEEP_TREES:
                    old, kept = kept, kept.map(_moved(trees[:-1], width, depth)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
                    trees = trees[-1:]
                sums, rows = added_at_root()
                if old is not None:
                    old.unpersist()
                    old = None
                all_rows = all_rows if roots else rows[0]
                root = _Node(1, int(all_rows[0, 0].sum()), int(sums[0, 0].sum()))
                splits, found = [(0, NO_BIN)] * ((1 << depth) - 1), {1: (sums[0], all_rows[0])}
                for level in range(depth):
                    halved = []
                    for place, (s, n) in found.items():
                        node = root.at(place)
                        _best(node, s, n, thresholds)
                        if node.split:
                            splits[place - 1] = node.split
                            halved.append((min(node.left, node.right, key=lambda x: x.rows).place, s, n))
                    if not halved or level == depth - 1:
                        break
                    # the smaller child is added up, the other one is what it leaves of its parent
                    sums, rows, _ = added(_child_sums(trees, splits, level + 1, [p - (2 << level) for p, _, _ in halved], depth, features, width))
                    found = {}
                    for i, (place, s, n) in enumerate(halved):
                        found[place], found[place ^ 1] = (sums[i], rows[0][i]), (s - sums[i], n - rows[0][i])
                root.pruned()
                roots.append(root)
                trees = [*trees, (_splits(root, depth), (step if m else 1.0) * np.array([root.leaf(i, depth).value for i in range(1 << depth)]))]
            added_at_root()
        finally:
            for x in (kept, old):
                if x is not None:
                    x.unpersist()
        return roots


def _splits(root: _Node, depth: int) -> list[tuple[int, int]]:
    found, todo = [(0, NO_BIN)] * ((1 << depth) - 1), [root]
    while todo:
        node = todo.pop()
        if node.split:
            found[node.place - 1] = node.split
            todo += [node.left, node.right]
    return found


def _put_squares(node: _Node, squared: np.ndarray, depth: int) -> None:
    """``squared``: of the last level's places; rows of a leaf above it are in the leftmost place below."""
    level = node.place.bit_length() - 1
    under = 1 << (depth - level)
    first = (node.place - (1 << level)) * under
    node.squares = int(squared[first:first + under].sum())
    if node.split:
        _put_squares(node.left, squared, depth)
        _put_squares(node.right, squared, depth)


def _model(spark: SparkSession, settings: GBTClassifier, roots: list[_Node], thresholds: list[np.ndarray]) -> GBTClassificationModel:
    """The trees as a model of pyspark.ml."""
    jvm, new = spark._jvm, spark.sparkContext._gateway.new_array
    tree, ml = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.ml

    def doubles(values):
        out = new(jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    def node(x: _Node):
        stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(
            doubles([x.rows, x.total / UNIT, x.squares / (UNIT * UNIT)]), x.rows)
        if not x.split:
            return tree.LeafNode(x.value, x.impurity if x.tried or x.place > 1 and not x.impurity else -1.0, stats)
        f, i = x.split
        return tree.InternalNode(x.value, x.impurity, x.gain, node(x.left), node(x.right), tree.ContinuousSplit(f, float(thresholds[f][i])), stats)

    kind = ml.regression.DecisionTreeRegressionModel
    trees = new(kind, len(roots))
    for i, root in enumerate(roots):
        trees[i] = kind(f"dtr_{settings.uid[-12:]}_{i}", node(root), len(thresholds))
    weights = doubles([1.0] + [settings.getStepSize()] * (len(roots) - 1))
    model = GBTClassificationModel(ml.classification.GBTClassificationModel(settings.uid, trees, weights, len(thresholds), 2))
    return settings._copyValues(model)
