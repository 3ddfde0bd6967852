"""Trees grown by this package as arrays and as Spark's own models."""

from __future__ import annotations

import json
import time
import uuid

import numpy as np
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import SparkSession

from estatelake.operators.binned import Layout
from estatelake.operators.boosting import Tree
from estatelake.operators.tree_arrays import TreeArrays
from estatelake.staging import staging_path

_NODE = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, "
    "rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
)


def weights_of(length: int, step: float) -> list[float]:
    return [1.0] + [step] * (length - 1)


def arrays_of(trees: list[Tree], layout: Layout, weights: list[float], averaged: bool = False) -> TreeArrays:
    """The arrays of grown trees (see ``tree_arrays``)."""
    sizes = [len(t.feature) for t in trees]
    roots = np.cumsum([0, *sizes[:-1]]).astype(np.int64)
    base, here = np.repeat(roots, sizes), np.arange(sum(sizes))
    feature, left, right = (np.concatenate([getattr(t, n) for t in trees]).astype(np.int64) for n in ("feature", "left", "right"))
    count, total = (np.concatenate([getattr(t, n) for t in trees]) for n in ("count", "sum"))
    slots = max(layout.kinds) + 1
    threshold, members, categorical = np.full(len(here), np.inf), [], np.zeros(len(here), bool)
    for node, goes in enumerate(g for t in trees for g in t.goes_left):
        if goes is None:
            continue
        categories, bound = _split(layout, feature[node], goes)
        categorical[node] = bound is None
        if bound is None:
            members += [node * slots + c for c in categories]
        else:
            threshold[node] = bound
    leaf = feature < 0
    return TreeArrays(
        roots, np.where(leaf, 0, feature), threshold, categorical, np.where(leaf, here, base + left), np.where(leaf, here, base + right),
        np.divide(total, count, out=np.zeros(len(here)), where=count > 0), np.array(weights), np.array(sorted(members) or [-1]), slots, averaged,
    )


def _split(layout: Layout, feature: int, goes_left: np.ndarray) -> tuple[list[int], float | None]:
    """(categories that go left, None) or ([], threshold)."""
    kinds = layout.kinds[feature]
    if kinds:
        return [int(c) for c in np.flatnonzero(goes_left[:kinds])], None
    return [], float(layout.thresholds[feature][int(goes_left.sum()) - 1])


def boosted_model(spark: SparkSession, estimator: GBTRegressor, trees: list[Tree], layout: Layout) -> GBTRegressionModel:
    return _model(spark, estimator, GBTRegressionModel, trees, weights_of(len(trees), estimator.getStepSize()), layout)


def forest_model(spark: SparkSession, estimator: RandomForestRegressor, trees: list[Tree], layout: Layout) -> RandomForestRegressionModel:
    return _model(spark, estimator, RandomForestRegressionModel, trees, [1.0] * len(trees), layout)


def _model(spark: SparkSession, estimator, kind, trees: list[Tree], weights: list[float], layout: Layout):
    """Spark's model of grown trees, by way of its saved form."""
    path = staging_path(spark, "grown")
    named = {p.name: v for p, v in estimator.extractParamMap().items()}
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {}}
    single = {n: named[n] for n in ("featuresCol", "labelCol", "predictionCol", "leafCol", "maxBins", "maxDepth", "minInstancesPerNode", "minInfoGain", "seed")}
    whole = about | {
        "class": f"org.apache.spark.ml.regression.{kind.__name__}", "uid": estimator.uid, "paramMap": named,
        "numFeatures": len(layout.kinds), "numTrees": len(trees),
    }
    parts = []
    for k, weight in enumerate(weights):
        uid = f"dtr_{uuid.uuid4().hex[:12]}"
        of_tree = about | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "uid": uid, "paramMap": single}
        parts.append((k, json.dumps(of_tree), weight))
    nodes = [(k, node) for k, tree in enumerate(trees) for node in _nodes(tree, layout)]
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(parts, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, f"treeID int, nodeData struct<{_struct(_NODE)}>").coalesce(1).write.parquet(f"{path}/data")
    return kind.load(path)


def _struct(schema: str) -> str:
    return ", ".join(f"{n}: {kind}" for n, kind in (part.split(" ", 1) for part in schema.split(", ", 8)))


def _nodes(tree: Tree, layout: Layout) -> list[tuple]:
    """The nodes of a tree as Spark saves them."""
    found = []
    for k, feature in enumerate(tree.feature):
        n, s, q = tree.count[k], tree.sum[k], tree.squares[k]
        mean = s / n if n else 0.0
        impurity = max(0.0, q / n - mean * mean) if n else 0.0
        split = (-1, [], -1)
        if feature >= 0:
            categories, bound = _split(layout, feature, tree.goes_left[k])
            split = (feature, [float(c) for c in categories], layout.kinds[feature]) if bound is None else (feature, [bound], -1)
        found.append((k, mean, impurity, [n, s, q], int(n), tree.gain[k], tree.left[k], tree.right[k], split))
    return found
