"""Tree ensembles as arrays: all trees, all shallower depths and all shorter ensembles in one walk.

A fitted ensemble lies on the driver; here its nodes become a few arrays, sent to the
executors once (the walk travels with them, so a cluster needs no copy of this module).  A batch of rows walks all trees together, level by level, so
no tree is a plan of its own.  Two grids follow from one fit:

* a greedy split does not depend on how deep its tree may grow, so a tree cut at a depth
  is a tree of that depth grown with the same draws (inner nodes hold the mean of
  their rows);
* the trees of a forest are independent and those of a boosted model follow each other, so
  the first k trees of an ensemble are an ensemble of k trees.

Least rows for a node, step sizes and, for boosted models, depths change the splits
themselves; each of their values needs a fit of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.staging import staging_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Nodes that a batch holds at once: rows times trees.
WALKED_AT_ONCE = 1 << 20


@dataclass(frozen=True)
class TreeArrays:
    """Nodes of all trees, one after the other; a leaf is its own child.

    Outputs of trees are ``averaged`` or added.  ``members`` has node * ``slots`` + category for each category that goes left, sorted.
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    categorical: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    weights: np.ndarray
    members: np.ndarray
    slots: int
    averaged: bool = False

    def walk(self, features: np.ndarray, cuts: Sequence[int | None] = (None,)) -> Iterator[tuple[int, np.ndarray]]:
        """For each cut, by rising depth: its place in ``cuts`` and the outputs, one row for each tree.

        ``features`` has a row for each row; a cut of None is the whole tree.
        """
        order = sorted(range(len(cuts)), key=lambda k: np.inf if cuts[k] is None else cuts[k])
        rows = np.arange(len(features))
        node = np.repeat(self.roots[:, None], len(features), axis=1)
        depth, ended = 0, False
        for k in order:
            while not ended and (cuts[k] is None or depth < cuts[k]):
                following = self._children(node, features, rows)
                ended = bool((following == node).all())
                node, depth = following, depth + 1
            yield k, self.prediction[node]

    def _children(self, node: np.ndarray, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
        values = features[rows[None, :], self.feature[node]]
        goes_left = values <= self.threshold[node]
        named = self.categorical[node]
        if named.any():
            wanted = node[named] * self.slots + values[named].astype(np.int64)
            at = np.searchsorted(self.members, wanted)
            goes_left[named] = self.members[np.minimum(at, len(self.members) - 1)] == wanted
        return np.where(goes_left, self.left[node], self.right[node])


def tree_arrays(spark: SparkSession, model: RandomForestRegressionModel | GBTRegressionModel) -> TreeArrays:
    """The arrays of a fitted ensemble, from its saved form."""
    path = staging_path(spark, "ensemble")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories",
    )
    table = nodes.toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
    tree, own, prediction, left, right, feature, _, kinds = (c.to_numpy() for c in table.columns)
    roots = np.flatnonzero(np.diff(tree, prepend=-1)).astype(np.int64)
    base = roots[tree]
    here = np.arange(len(tree))
    assert (own == here - base).all()
    leaf, categorical = left < 0, kinds >= 0
    split = table.column("leftCategoriesOrThreshold").combine_chunks()
    starts, values = split.offsets.to_numpy(), split.flatten().to_numpy()
    sizes = np.diff(starts)
    threshold = np.full(len(tree), np.inf)
    plain = ~leaf & ~categorical
    threshold[plain] = values[starts[:-1][plain] - starts[0]]
    slots = int(max(kinds.max(initial=0), 0)) + 1
    listed = np.repeat(categorical, sizes)
    members = np.sort(np.repeat(here, sizes)[listed] * slots + values[listed].astype(np.int64))
    return TreeArrays(
        roots, np.where(leaf, 0, feature).astype(np.int64), threshold, categorical & ~leaf,
        np.where(leaf, here, base + left), np.where(leaf, here, base + right), prediction,
        np.array(model.treeWeights), members if len(members) else np.full(1, -1), slots, isinstance(model, RandomForestRegressionModel),
    )


def tree_outputs(
    spark: SparkSession, model: RandomForestRegressionModel | GBTRegressionModel, features: str, size: int
) -> Column:
    """The outputs of all trees of an ensemble, as an array, for a vector column of ``size`` elements."""
    shared = spark.sparkContext.broadcast(vars(tree_arrays(spark, model)))

    @F.arrow_udf("array<double>")
    def outputs(*columns: pa.Array) -> pa.Array:
        trees = TreeArrays(**shared.value)
        matrix = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
        found = [np.empty(0)]
        for low in range(0, len(matrix), step := max(1, WALKED_AT_ONCE // len(trees.roots))):
            found += [r.T.ravel() for _, r in trees.walk(matrix[low : low + step])]
        ends = np.arange(len(matrix) + 1, dtype=np.int32) * len(trees.roots)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))

    return outputs(*elements(features, size))


def elements(vector: str, size: int) -> list[Column]:
    return [F.get(vector_to_array(vector), F.lit(k)) for k in range(size)]


def nested_errors(
    held: DataFrame, model: RandomForestRegressionModel | GBTRegressionModel | TreeArrays, features: str, size: int, target: str,
    lengths: Sequence[int], cuts: Sequence[int | None],
) -> dict[tuple[int, int | None], tuple[float, int]]:
    """(mean squared error, rows) for the first ``length`` trees cut at each depth, in one pass over ``held``."""
    arrays = model if isinstance(model, TreeArrays) else tree_arrays(held.sparkSession, model)
    shared = held.sparkSession.sparkContext.broadcast(vars(arrays))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = TreeArrays(**shared.value)
        for batch in batches:
            matrix, wanted = batch.iloc[:, 1:].to_numpy(), batch.iloc[:, 0].to_numpy()
            rows = []
            for low in range(0, len(matrix), step := max(1, WALKED_AT_ONCE // len(trees.roots))):
                part, truth = matrix[low : low + step], wanted[low : low + step]
                for k, outputs in trees.walk(part, cuts):
                    so_far = np.cumsum(outputs * trees.weights[:, None], axis=0)
                    for place, length in enumerate(lengths):
                        total = so_far[min(length, len(so_far)) - 1]
                        if trees.averaged:
                            total = total / trees.weights[:length].sum()
                        rows.append((place, k, float(((total - truth) ** 2).sum()), len(truth)))
            yield pd.DataFrame(rows, columns=["place", "cut", "squares", "n"])

    numbers = held.where(F.col(target).isNotNull()).select(F.col(target).cast("double"), *elements(features, size))
    found = numbers.mapInPandas(sums, "place int, cut int, squares double, n long").groupBy("place", "cut")
    return {
        (lengths[r["place"]], cuts[r["cut"]]): (r["squares"] / r["n"], r["n"])
        for r in found.agg(F.sum("squares").alias("squares"), F.sum("n").alias("n")).collect()
    }
