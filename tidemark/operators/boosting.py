"""Boosted trees over binned rows: Spark's estimator and model, fitted from compact blocks.

Spark keeps every training row as several objects and makes them anew in each pass, of which a round needs one per level.
Here the features are binned once and a partition holds its rows as a few arrays: a byte a feature, the label, the weight
and the sum of the trees so far. A level of a tree is one Spark job, in which every partition adds its rows up per open
node, feature and bin; the sums of all partitions choose the splits. Candidates, gains, stopping and leaf values are those
of ``pyspark.ml``, except that the candidates come from all rows and not from a sample of ten thousand.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import classification
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir, ship

# Points of a feature's distribution that the candidates are chosen from, and the error of their ranks.
GRID, GRID_ERROR = 2048, 1 / 8192
# Rows that are looked at in one go.
BLOCK_ROWS = 1 << 16
# The sums of the trees are made anew from the binned rows every so many rounds: a lost block needs no more rounds than that.
REBUILD = 40
EPSILON = 2.0**-52
NODE = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int, "
    "rightChild int, split struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>"
)


@dataclass
class Block:
    """Some rows: their bins (feature by row), labels (-1 or 1), weights and the trees' sum."""

    bins: np.ndarray
    sign: np.ndarray
    weight: np.ndarray
    total: np.ndarray


@dataclass
class Tree:
    """Nodes in heap order: ``cut`` is the last bin that goes left. What lies below a leaf has the leaf's value."""

    depth: int
    scale: float
    first: bool
    feature: dict[int, int] = field(default_factory=dict)
    cut: dict[int, int] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)
    sums: dict[int, np.ndarray] = field(default_factory=dict)

    def place(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """Where the rows are after so many levels, counted from the left."""
        at = np.zeros(bins.shape[1], np.uint16)
        for level in range(levels):
            right = np.zeros(bins.shape[1], bool)
            for i in range(1 << level):
                node = (1 << level) - 1 + i
                if node in self.feature:
                    right |= (at == i) & (bins[self.feature[node]] > self.cut[node])
            at = 2 * at + right
        return at

    def leaves(self) -> np.ndarray:
        """The value of every place at full depth."""
        values = np.zeros(1 << self.depth)
        for i in range(1 << self.depth):
            node = (1 << self.depth) - 1 + i
            while node not in self.sums:
                node = (node - 1) // 2
            values[i] = mean(self.sums[node])
        return values

    def add(self, block: Block) -> Block:
        total = block.total + self.scale * self.leaves()[self.place(block.bins, self.depth)]
        return Block(block.bins, block.sign, block.weight, total)


def mean(sums: np.ndarray) -> float:
    return float(sums[2] / sums[1])


def impurity(sums: np.ndarray) -> np.ndarray:
    """The variance: of rows counted, weighed, and their targets and squares weighed and summed."""
    weight, first, second = sums[..., 1], sums[..., 2], sums[..., 3]
    return (second - first * first / weight) / weight


def target(block: Block, first: bool) -> np.ndarray:
    """What a tree is to predict: the label, and from the second tree on the downhill slope of the logistic loss."""
    return block.sign.astype(float) if first else 4.0 * block.sign / (1.0 + np.exp(2.0 * block.sign * block.total))


def histogram(block: Block, tree: Tree, level: int, width: int) -> np.ndarray:
    """Per node of the level, feature and bin: rows, weight, weighted targets, weighted squares.

    Two features are counted at once, by their pair of bins.
    """
    nodes, n = 1 << level, len(block.bins)
    want = target(block, tree.first)
    moved = block.weight * want
    columns = (None, block.weight, moved, moved * want)
    at = tree.place(block.bins, level).astype(np.intp) * width
    out = np.zeros((nodes, n, width, len(columns)))
    for a in range(0, n, 2):
        b = min(a + 1, n - 1)
        cell = (at + block.bins[a]) * width + block.bins[b]
        for k, column in enumerate(columns):
            pairs = np.bincount(cell, column, nodes * width * width).reshape(nodes, width, width)
            out[:, a, :, k], out[:, b, :, k] = pairs.sum(2), pairs.sum(1)
    return out


def grow(tree: Tree, level: int, sums: np.ndarray, splits: list[np.ndarray]) -> None:
    """Splits the nodes of a level where that lowers the variance most."""
    for i, each in enumerate(sums):
        node = (1 << level) - 1 + i
        if level == 0:
            tree.sums[node] = each[0].sum(0)
        elif (node - 1) // 2 not in tree.feature:
            continue
        if impurity(tree.sums[node]) < EPSILON:
            continue
        whole, best = tree.sums[node], (0.0, -1, -1, None, None)
        for f, cuts in enumerate(splits):
            left = each[f].cumsum(0)[: len(cuts)]
            right = whole - left
            # Counts tell empty sides exactly; differences of weights leave rests.
            inside = np.flatnonzero((left[:, :2] > 0).all(1) & (right[:, :2] > 0).all(1))
            if len(inside):
                low, high = left[inside], right[inside]
                shares = low[:, 1] * impurity(low) + high[:, 1] * impurity(high)
                gains = impurity(whole) - shares / whole[1]
                k = int(gains.argmax())
                if gains[k] > best[0]:
                    best = (float(gains[k]), f, int(inside[k]), low[k], high[k])
        if best[1] >= 0:
            tree.gain[node], tree.feature[node], tree.cut[node] = best[:3]
            tree.sums[2 * node + 1], tree.sums[2 * node + 2] = best[3:]


def nodes_of(tree: Tree, splits: list[np.ndarray]) -> list[tuple]:
    """The tree as its model stores it: numbered in preorder, without splits into two leaves of one value."""
    out: list[tuple] = []

    def leaf(number: int) -> bool:
        if number not in tree.feature:
            return True
        low, high = 2 * number + 1, 2 * number + 2
        return leaf(low) and leaf(high) and mean(tree.sums[low]) == mean(tree.sums[high])

    def walk(number: int) -> int:
        at, sums = len(out), tree.sums[number]
        row = (at, mean(sums), float(impurity(sums)), [float(x) for x in sums[1:]], int(sums[0]))
        out.append(row)
        if leaf(number):
            out[at] = (*row, -1.0, -1, -1, (-1, [], -1))
        else:
            f = tree.feature[number]
            below, above = walk(2 * number + 1), walk(2 * number + 2)
            out[at] = (*row, tree.gain[number], below, above, (f, [float(splits[f][tree.cut[number]])], -1))
        return at

    walk(0)
    return out


def candidates(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between ascending values: all of them, or those nearest to equal shares of the weight."""
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) < bins:
        return middle
    stride = weights.sum() / bins
    upto, goal, cuts = weights[0], stride, []
    for i in range(1, len(values)):
        before, upto = upto, upto + weights[i]
        if abs(before - goal) < abs(upto - goal):
            cuts.append(middle[i - 1])
            goal += stride
    return np.array(cuts[: bins - 1])


def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (feature by row), labels and weights of a batch."""
    for column in batch.columns:
        if column.null_count:
            raise ValueError("features, labels and weights must not be null")
    features = [c.to_numpy() for c in batch.columns[:-2]]
    label, weight = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
    if not np.isin(label, (0.0, 1.0)).all():
        raise ValueError("labels must be 0 or 1")
    return np.stack(features), label, weight


def weigh(rows: DataFrame, grids: list[np.ndarray]) -> list[np.ndarray]:
    """The weight of the rows next to each point of each grid: above the point before, up to the point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros(len(g)) for g in grids]
        for batch in batches:
            features, _, weight = arrays(batch)
            for own, grid, values in zip(found, grids, features):
                own += np.bincount(np.minimum(np.searchsorted(grid, values), len(grid) - 1), weight, len(grid))
        yield pa.RecordBatch.from_arrays([pa.array([f.tobytes() for f in found]), pa.array(range(len(found)))], ["w", "f"])

    out = [np.zeros(len(g)) for g in grids]
    for row in rows.mapInArrow(run, "w binary, f long").collect():
        out[row["f"]] += np.frombuffer(row["w"])
    return out


def binned(rows: DataFrame, splits: list[np.ndarray]) -> RDD:
    """The rows as blocks."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        features, label, weight = (np.concatenate(part, axis=-1) for part in zip(*map(arrays, held)))
        bins = np.stack([np.searchsorted(s, v).astype(np.uint8) for s, v in zip(splits, features)])
        sign = (2 * label - 1).astype(np.int8)
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in (bins, sign, weight)], ["bins", "sign", "weight"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    def block(row) -> Block:
        sign = np.frombuffer(row["sign"], np.int8)
        bins = np.frombuffer(row["bins"], np.uint8).reshape(len(splits), len(sign))
        return Block(bins, sign, np.frombuffer(row["weight"]), np.zeros(len(sign)))

    return rows.mapInArrow(run, "bins binary, sign binary, weight binary").rdd.map(block)


def choose_splits(rows: DataFrame, names: list[str], bins: int) -> list[np.ndarray]:
    """The candidates of every feature, from all rows."""
    points = rows.approxQuantile(names, [i / GRID for i in range(GRID + 1)], GRID_ERROR)
    grids = [np.unique(p) for p in points]
    return [candidates(g, w, bins) for g, w in zip(grids, weigh(rows, grids))]


def add_up(tree: Tree, level: int, width: int) -> Callable[[Iterator[Block]], Iterator[np.ndarray]]:
    def run(part: Iterator[Block]) -> Iterator[np.ndarray]:
        out = None
        for block in part:
            one = histogram(block, tree, level, width)
            out = one if out is None else out + one
        return iter([] if out is None else [out])

    return run


def added(done: list[Tree]) -> Callable[[Block], Block]:
    def run(block: Block) -> Block:
        for tree in done:
            block = tree.add(block)
        return block

    return run


def fit_trees(blocks: RDD, splits: list[np.ndarray], rounds: int, depth: int, step: float) -> list[Tree]:
    """The trees one after the other, a job a level."""
    width = max(len(s) for s in splits) + 1
    trees: list[Tree] = []
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    state = before = blocks
    for m in range(rounds):
        tree = Tree(depth, step if m else 1.0, m == 0)
        for level in range(depth):
            # Few numbers a partition, added up in the order of the partitions.
            grow(tree, level, sum(state.mapPartitions(add_up(tree, level, width)).collect()), splits)
            if before is not blocks:
                before.unpersist()
                before = blocks
            if not any(node in tree.feature for node in range((1 << level) - 1, (2 << level) - 1)):
                break
        trees.append(tree)
        if m + 1 < rounds:
            again = (m + 1) % REBUILD == 0
            before = state
            state = (blocks if again else state).map(added(trees[:] if again else [tree]))
            state.persist(StorageLevel.MEMORY_AND_DISK)
    for cached in (state, blocks):
        cached.unpersist()
    return trees


def stored_model(estimator: classification.GBTClassifier, spark: SparkSession, trees: list[Tree], splits: list[np.ndarray]):
    """The trees as Spark's own model, by way of the files that it is loaded from."""
    path = scratch_dir(spark, "boosted")
    estimator.write().save(f"{path}/estimator")
    about = json.loads(spark.read.text(f"{path}/estimator/metadata").first()["value"])
    kind = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    each = [
        json.dumps({**about, "class": kind, "uid": f"dtr_{i}", "paramMap": {"maxDepth": tree.depth}, "defaultParamMap": {}})
        for i, tree in enumerate(trees)
    ]
    whole = {**about, "class": "org.apache.spark.ml.classification.GBTClassificationModel"}
    whole |= {"numFeatures": len(splits), "numTrees": len(trees)}

    def write(rows: list[tuple], schema: str, name: str, form: str) -> None:
        spark.createDataFrame(rows, schema).coalesce(1).write.format(form).save(f"{path}/model/{name}")

    write([(json.dumps(whole),)], "value string", "metadata", "text")
    kept = [(i, text, tree.scale) for i, (tree, text) in enumerate(zip(trees, each))]
    write(kept, "_1 int, _2 string, _3 double", "treesMetadata", "parquet")
    nodes = [(i, node) for i, tree in enumerate(trees) for node in nodes_of(tree, splits)]
    write(nodes, f"treeID int, nodeData struct<{NODE}>", "data", "parquet")
    return classification.GBTClassificationModel.load(f"{path}/model")


class GBTClassifier(classification.GBTClassifier):
    """Spark's estimator with another way to fit. Nothing is drawn, so the seed makes no difference."""

    def _fit(self, dataset: DataFrame) -> classification.GBTClassificationModel:
        plain = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 1, "minInfoGain": 0.0}
        plain |= {"minWeightFractionPerNode": 0.0, "validationIndicatorCol": None}
        for name, value in plain.items():
            if self.isDefined(name) and self.getOrDefault(name) != value:
                raise ValueError(f"{name} is not supported")
        if self.getMaxBins() > 256:
            raise ValueError("at most 256 bins")
        spark = dataset.sparkSession
        ship(spark)
        weight = F.col(self.getWeightCol()) if self.isDefined("weightCol") else F.lit(1.0)
        features = vector_to_array(self.getFeaturesCol()).alias("x")
        rows = dataset.select(features, F.col(self.getLabelCol()).cast("double").alias("label"), weight.cast("double").alias("weight"))
        rows = rows.persist()
        n = rows.agg(F.max(F.size("x"))).first()[0]
        if n is None:
            raise ValueError("no rows to learn from")
        names = [f"x{i}" for i in range(n)]
        rows_of = rows.select(*[F.col("x")[i].alias(c) for i, c in enumerate(names)], "label", "weight")
        splits = choose_splits(rows_of, names, self.getMaxBins())
        trees = fit_trees(binned(rows_of, splits), splits, self.getMaxIter(), self.getMaxDepth(), self.getStepSize())
        rows.unpersist()
        return stored_model(self, spark, trees, splits)
