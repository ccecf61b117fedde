"""Random forests and boosted trees of large tables, grown level by level on binned rows.

The method is MLlib's: candidate cuts at equal shares of sampled rows, rows drawn with replacement for each
tree and a subset of the features for each node (forest), signs first and then gradients of the
logistic loss (boosting), all nodes of a level in one scan.  MLlib holds an object of some
540 bytes a row for a forest; here a row takes a byte a feature, its draws repeat from a seed, and
sums are taken by array.  The result is MLlib's own model, made from the nodes.  A forest draws other
numbers than MLlib would, and boosted nodes keep no impurity (-1).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import binned
from gaugeline.sources.workspace import new_path, release_tables, stage_table

#: Rows that the candidate cuts are taken from; MLlib looks at 10,000.
CUT_ROWS = 100_000
#: Boosted trees after which the scores of all rows are stored again.
TREES_BETWEEN = 3
LEAST_GAIN = 1e-12
LEAF = 255
NODE_DDL = """treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint,
 gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"""


def grows(estimator) -> bool:
    """Whether an estimator is a forest or boosting whose parameters are known here."""
    if type(estimator) not in (RandomForestClassifier, GBTClassifier):
        return False
    forest = type(estimator) is RandomForestClassifier
    value = lambda name: estimator.getOrDefault(estimator.getParam(name))
    plain = {"subsamplingRate": 1.0, "minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0}
    plain |= {"impurity": "gini", "featureSubsetStrategy": "auto", "bootstrap": True} if forest else {"featureSubsetStrategy": "all"}
    unset = ["weightCol", "thresholds", *([] if forest else ["validationIndicatorCol"])]
    return (
        all(value(name) == wanted for name, wanted in plain.items())
        and not any(estimator.isSet(estimator.getParam(name)) for name in unset)
        and value("maxBins") <= LEAF
        and value("maxDepth") <= 12
        and (not forest or value("numTrees") > 1)
    )


class _Trees:
    """Complete trees as arrays, filled level by level."""

    def __init__(self, trees: int, depth: int):
        inner = (1 << depth) - 1
        self.depth = depth
        self.feature, self.cut = np.zeros((trees, inner), np.intp), np.full((trees, inner), LEAF, np.uint8)
        self.gain, self.rows, self.target = np.zeros((trees, inner)), np.zeros((trees, 2 * inner + 1)), np.zeros((trees, 2 * inner + 1))

    def fill(self, tree: int, nodes: np.ndarray, look: np.ndarray, found: np.ndarray, labels: bool) -> np.ndarray:
        """Takes the best splits of some nodes; returns the children that may be split again."""
        place, cut, gain, rows, target, left_rows, left_target = found.T
        if nodes[0] == 0:
            self.rows[tree, 0], self.target[tree, 0] = rows[0], target[0]
        good = gain > LEAST_GAIN * np.maximum(rows, 1)
        nodes, place, cut = nodes[good], place[good].astype(int), cut[good]
        self.feature[tree, nodes], self.cut[tree, nodes], self.gain[tree, nodes] = look[good, place], cut, gain[good] / rows[good]
        children = np.stack([2 * nodes + 1, 2 * nodes + 2], axis=1)
        self.rows[tree, children] = np.stack([left_rows, rows - left_rows], axis=1)[good]
        self.target[tree, children] = np.stack([left_target, target - left_target], axis=1)[good]
        children = children.ravel()
        if not labels:
            return children
        mixed = (self.target[tree, children] > 0) & (self.target[tree, children] < self.rows[tree, children])
        return children[mixed]

    def values(self, tree: int) -> np.ndarray:
        """Mean target of the leaf that ends at each bottom node."""
        inner = len(self.cut[tree])
        out = np.zeros(inner + 1)
        for node in range(2 * inner + 1):
            if self.rows[tree, node] and (node >= inner or self.cut[tree, node] == LEAF):
                level = (node + 1).bit_length() - 1
                out[((node + 1) << (self.depth - level)) - 1 - inner] = self.target[tree, node] / self.rows[tree, node]
        return out

    def nodes(self, tree: int, cuts: list[np.ndarray], forest: bool) -> list[dict]:
        """Nodes in the order of MLlib's files; children that predict the same class are one leaf, as there."""
        out: list[dict] = []

        def visit(node: int) -> int:
            place = len(out)
            n, s = float(self.rows[tree, node]), float(self.target[tree, node])
            share = s / n if n else 0.0
            own = {"id": place, "rawCount": round(n), "gain": -1.0, "leftChild": -1, "rightChild": -1}
            own["split"] = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
            if forest:
                own |= {"prediction": float(s > n - s), "impurity": 2 * share * (1 - share), "impurityStats": [n - s, s]}
            else:
                own |= {"prediction": share, "impurity": -1.0, "impurityStats": [n, s, s * share]}
            out.append(own)
            if node < len(self.cut[tree]) and self.cut[tree, node] != LEAF:
                left, right = visit(2 * node + 1), visit(2 * node + 2)
                if out[left]["leftChild"] < 0 and out[right]["leftChild"] < 0 and out[left]["prediction"] == out[right]["prediction"]:
                    del out[place + 1 :]
                    return place
                feature = int(self.feature[tree, node])
                own |= {"leftChild": left, "rightChild": right, "gain": float(self.gain[tree, node]) * (2 if forest else 1)}
                own["split"] = {"featureIndex": feature, "leftCategoriesOrThreshold": [float(cuts[feature][self.cut[tree, node]])], "numCategories": -1}
            return place

        visit(0)
        return out


def _grow(chunks: DataFrame, trees: int, depth: int, features: int, bins: int, width: int, seed: int | None, since: Sequence) -> _Trees:
    """Trees that grow side by side, one scan a level."""
    context = chunks.sparkSession.sparkContext
    grown = _Trees(trees, depth)
    active = [np.zeros(1, np.intp) for _ in range(trees)]
    for level in range(depth):
        first = (1 << level) - 1
        numbers, looks = [], []
        for tree, nodes in enumerate(active):
            number = np.full(1 << level, -1, np.intp)
            number[nodes - first] = np.arange(len(nodes))
            numbers.append(number)
            if width == features:
                looks.append(np.tile(np.arange(features), (len(nodes), 1)))
            else:
                looks.append(np.random.default_rng([seed, tree, level]).random((len(nodes), features)).argsort(axis=1)[:, :width])
        held = context.broadcast((level, list(grown.feature[:, :first]) if level else [np.zeros(1, np.intp)] * trees,
                                  list(grown.cut[:, :first]) if level else [np.full(1, LEAF, np.uint8)] * trees, numbers, looks, since))
        sums = chunks.mapInArrow(binned.level_sums(held, seed, bins), binned.SUMS_DDL)
        sums = sums.repartition(min(trees, 64), "tree").sortWithinPartitions("tree", "part", "chunk")
        best = sums.mapInArrow(binned.best_splits(width, bins, "<f8" if seed is None else "<u4"), "tree int, splits binary").collect()
        held.unpersist()
        following = [np.zeros(0, np.intp)] * trees
        for row in best:
            tree, found = row["tree"], np.frombuffer(row["splits"]).reshape(-1, 7)
            following[tree] = grown.fill(tree, active[tree], looks[tree], found, seed is not None)
        active = following
        if not any(len(nodes) for nodes in active):
            break
    return grown


def _boost(chunks: DataFrame, estimator, features: int, bins: int) -> list[_Trees]:
    found, since, paths = [], [], []
    for number in range(estimator.getMaxIter()):
        grown = _grow(chunks, 1, estimator.getMaxDepth(), features, bins, features, None, since)
        found.append(grown)
        since = [*since, (grown.feature[0], grown.cut[0], grown.values(0), estimator.getStepSize() if number else 1.0)]
        if len(since) == TREES_BETWEEN and number + 1 < estimator.getMaxIter():
            chunks = stage_table(chunks.mapInArrow(binned.rescored(since), binned.CHUNK_DDL), "boosted-rows", paths)
            release_tables(chunks.sparkSession, paths[:-1])
            paths, since = paths[-1:], []
    release_tables(chunks.sparkSession, paths)
    return found


def grow_model(estimator, rows: DataFrame, row_count: int):
    """The estimator's model for rows of ``label`` (0 or 1) and ``features``."""
    spark = rows.sparkSession
    arrays = rows.select("label", vector_to_array("features").alias("x"))
    every = max(1, row_count // CUT_ROWS)
    seen = arrays.mapInArrow(binned.every_nth(every), "label double, x array<double>").toArrow()
    values = seen.column("x").combine_chunks().flatten().to_numpy().reshape(seen.num_rows, -1)
    bins = estimator.getMaxBins()
    cuts = [binned.candidate_cuts(v, bins) for v in values.T]
    features = len(cuts)
    paths: list[str] = []
    chunks = stage_table(arrays.mapInArrow(binned.pack(cuts), binned.CHUNK_DDL), "binned-rows", paths)
    forest = type(estimator) is RandomForestClassifier
    if forest:
        width = math.ceil(math.sqrt(features))
        seed = estimator.getSeed() & ((1 << 63) - 1)
        grown = _grow(chunks, estimator.getNumTrees(), estimator.getMaxDepth(), features, bins, width, seed, [])
        nodes = [grown.nodes(tree, cuts, True) for tree in range(estimator.getNumTrees())]
    else:
        nodes = [grown.nodes(0, cuts, False) for grown in _boost(chunks, estimator, features, bins)]
    release_tables(spark, paths)
    return _model(spark, estimator, features, nodes)


def _model(spark, estimator, features: int, nodes: list[list[dict]]):
    """MLlib's model with these nodes: saved from a fit on two rows, its nodes replaced, and loaded."""
    pair = spark.range(0, 2, 1, 1).select(F.col("id").cast("double").alias("label"), F.array(*[F.col("id").cast("double")] * features).alias("x"))
    template = estimator.fit(pair.select("label", array_to_vector("x").alias("features")))
    path = new_path(spark, "grown-model")
    template.write().save(path)
    table = pa.table({"treeID": pa.array([tree for tree, own in enumerate(nodes) for _ in own], pa.int32()), "nodeData": [n for own in nodes for n in own]})
    held = spark.createDataFrame(table).to(spark.createDataFrame([], NODE_DDL).schema)
    held.write.mode("overwrite").parquet(f"{path}/data")
    return type(template).load(path)
