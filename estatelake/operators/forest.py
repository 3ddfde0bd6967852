"""Random forests grown level by level over blocks of bins.

All trees of a forest share the jobs, two for each level.  The rows stay in the executors' memory, with how often each tree
draws a row and the node where it is.  Tasks add up counts and sums by node and bin of the features that a
node may use; these tables are shuffled by tree, and who adds those of a tree picks its splits, so the driver gets splits
only.  As in Spark's ``RandomForestRegressor`` a tree draws rows with replacement (Poisson counts) and
each node a third of the features; the draws are others than Spark's.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame

from estatelake.operators.binned import Layout, Splits, best_splits
from estatelake.operators.boosting import CHUNK, LEAST_GAIN, TASK_ROWS, Tree

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Deeper trees have more nodes than a task's tables may hold; they stay with Spark.
DEEPEST = 12
# Rows that a task works on at once, a block at least; bytes of its tables.
ROWS_TOGETHER = 1 << 16
TABLE_BYTES = 1 << 27

# A block of rows: bins (feature by feature), targets, and for each tree the draws and the place among the growing nodes (-1: none).
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Forest:
    """Settings of a forest fitted to all rows but those of the fold ``held``."""

    trees: int
    depth: int
    least_rows: int
    least_gain: float
    seed: int
    held: int | None = None

    @classmethod
    def of(cls, estimator: RandomForestRegressor, held: int | None = None) -> Forest:
        e = estimator
        return cls(e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode(), e.getMinInfoGain(), e.getSeed(), held)

    def asked(self, features: int) -> int:
        """Features that a node may use."""
        return features if self.trees == 1 else math.ceil(features / 3)


def grows_here(estimator) -> bool:
    """Whether the estimator's trees are plain and shallow enough for this module."""
    return (
        isinstance(estimator, RandomForestRegressor) and 0 < estimator.getMaxDepth() <= DEEPEST and estimator.getSubsamplingRate() == 1.0
        and estimator.getBootstrap() and estimator.getFeatureSubsetStrategy() == "auto" and estimator.getMinWeightFractionPerNode() == 0.0
        and not estimator.isDefined("weightCol")
    )


def grow(blocks: DataFrame, rows: int, layout: Layout, plan: Forest, exact: bool = False) -> list[Tree]:
    """The trees, from ``rows`` rows as blocks of bins and targets (see ``binned``); with ``exact`` nodes have their sums of squares."""
    context = blocks.sparkSession.sparkContext
    tasks = min(context.defaultParallelism, max(1, rows // TASK_ROWS))
    kept = blocks if plan.held is None else blocks.where(blocks["fold"] != plan.held)
    parts = kept.select("codes", "target").repartition(tasks).rdd
    state = parts.mapPartitions(_loading(layout, plan)).persist(StorageLevel.MEMORY_AND_DISK)
    trees = [Tree() for _ in range(plan.trees)]
    for tree in trees:
        tree.add(0.0, 0.0)
    frontier = {k: [0] for k in range(plan.trees)}
    for level in range(plan.depth + exact):
        grows = level < plan.depth
        draws = {k: _draws(plan, k, level, len(nodes), len(layout.kinds)) for k, nodes in frontier.items()}
        moves: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        following: dict[int, list[int]] = {}
        for some in _groups(draws, max(layout.bins)):
            asked = {k: draws[k] for k in some}
            totals = {k: _totals(trees[k], frontier[k]) for k in some} if level else {}
            for k, splits, squares, root in _level(state, asked, totals, layout, plan.least_rows, grows, exact, tasks):
                tree = trees[k]
                if root is not None:
                    tree.count[0], tree.sum[0] = root
                if exact:
                    for node, q in zip(frontier[k], squares):
                        tree.squares[node] = float(q)
                if grows:
                    moves[k], following[k] = _split(tree, frontier[k], draws[k], splits, plan.least_gain)
        if not trees[0].count[0]:
            raise ValueError(f"no rows to fit beside fold {plan.held}")
        frontier = {k: nodes for k, nodes in following.items() if nodes}
        if not frontier or level + 1 == plan.depth + exact:
            break
        before, state = state, state.mapPartitions(_moving(moves)).persist(StorageLevel.MEMORY_AND_DISK)
        state.foreachPartition(lambda found: [None for _ in found])
        before.unpersist()
    state.unpersist()
    return trees


def _loading(layout: Layout, plan: Forest):
    size, dtype = len(layout.kinds), layout.dtype

    def drawn_block(parts: list[tuple[bytes, bytes]]) -> Block:
        codes = np.concatenate([np.frombuffer(c, dtype).reshape(size, -1) for c, _ in parts], axis=1)
        truth = np.concatenate([np.frombuffer(t, np.float64) for _, t in parts])
        draws = []
        for part in parts:
            # The draws follow from what a block holds, so a block that is read again draws the same.
            rng = np.random.default_rng([plan.seed & 0xFFFFFFFF, *map(zlib.crc32, part)])
            draws.append(rng.poisson(1.0, (plan.trees, len(part[1]) // 8)).astype(np.uint8))
        drawn = np.concatenate(draws, axis=1)
        return codes, truth, drawn, np.where(drawn > 0, 0, -1).astype(np.int16)

    def load(found: Iterable) -> Iterator[Block]:
        parts, n = [], 0
        for codes, target in found:
            parts.append((codes, target))
            n += len(target) // 8
            if n >= ROWS_TOGETHER:
                yield drawn_block(parts)
                parts, n = [], 0
        if parts:
            yield drawn_block(parts)

    return load


def _draws(plan: Forest, tree: int, level: int, nodes: int, features: int) -> np.ndarray:
    """The features of each node, ascending."""
    rng = np.random.default_rng([plan.seed & 0xFFFFFFFF, tree, level])
    return np.sort(np.argsort(rng.random((nodes, features)), axis=1)[:, : plan.asked(features)], axis=1)


def _groups(draws: dict[int, np.ndarray], widest: int) -> list[list[int]]:
    """Trees whose tables a task holds together."""
    groups, used = [], TABLE_BYTES
    for k, own in draws.items():
        size = 16 * own.size * widest
        if used + size > TABLE_BYTES:
            groups.append([])
            used = 0
        groups[-1].append(k)
        used += size
    return groups


def _totals(tree: Tree, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([tree.count[n] for n in nodes]), np.array([tree.sum[n] for n in nodes])


def _level(
    state: RDD, draws: dict[int, np.ndarray], totals: dict, layout: Layout, least_rows: int, grows: bool, exact: bool, tasks: int
) -> list[tuple[int, Splits | None, np.ndarray, tuple[float, float] | None]]:
    """For each tree the best splits of its growing nodes, their sums of squares and (of the first level) count and sum of the root."""
    widest, kinds = max(layout.bins), np.array(layout.kinds)
    sizes = {k: own.size * widest * grows for k, own in draws.items()}

    def tables(found: Iterable[Block]) -> Iterator[tuple[int, np.ndarray]]:
        own = {k: np.zeros(2 * sizes[k] + len(draws[k]) * exact) for k in draws}
        for codes, truth, drawn, place in found:
            for k in draws:
                add_block(own[k], sizes[k], draws[k], codes, truth, drawn[k], place[k], widest, exact)
        yield from own.items()

    def pick(k: int, table: np.ndarray) -> tuple:
        asked, size = draws[k], sizes[k]
        squares = table[2 * size :]
        if not grows:
            return k, None, squares, None
        counts, sums = (t.reshape(*asked.T.shape, widest) for t in (table[:size], table[size : 2 * size]))
        n, s = totals.get(k) or (counts[0].sum(axis=1), sums[0].sum(axis=1))
        found = best_splits(list(counts), list(sums), list(kinds[asked.T]), n, s, least_rows)
        return k, found, squares, None if totals else (float(n[0]), float(s[0]))

    added = state.mapPartitions(tables).reduceByKey(np.add, min(tasks, len(draws)))
    return added.map(lambda item: pick(*item)).collect()


def add_block(
    table: np.ndarray, size: int, draws: np.ndarray, codes: np.ndarray, truth: np.ndarray, drawn: np.ndarray, place: np.ndarray, widest: int, exact: bool
) -> None:
    """Adds a block's counts and sums by drawn feature, node and bin, then the nodes' sums of squares, to a tree's table."""
    n, flat = len(truth), codes.reshape(-1)
    rows = np.flatnonzero(place >= 0)
    own, times, goal = place.take(rows).astype(np.intp), drawn.take(rows).astype(np.float64), truth.take(rows)
    goal *= times
    if exact:
        table[2 * size :] += np.bincount(own, goal * truth.take(rows), len(draws))
    if not size:
        return
    bins = len(draws) * widest
    for j, asked in enumerate(draws.T):
        at = asked.take(own)
        at *= n
        at += rows
        key = own * widest
        key += flat.take(at)
        for low, weights in ((j * bins, times), (size + j * bins, goal)):
            table[low : low + bins] += np.bincount(key, weights, bins)


def _split(
    tree: Tree, nodes: list[int], draws: np.ndarray, best: Splits, least_gain: float
) -> tuple[tuple[np.ndarray, np.ndarray], list[int]]:
    """Splits the nodes of a level: the features they ask for and the place that follows for each bin, and the nodes of the next."""
    feature = np.zeros(len(nodes) + 1, np.intp)
    following = np.full((len(nodes) + 1, best.goes_left.shape[1]), -1, np.int16)
    grown: list[int] = []
    for k, node in enumerate(nodes):
        n, s = tree.count[node], tree.sum[node]
        gain = best.gain[k] / n if n else -np.inf
        if not gain > 0 or gain < least_gain or best.gain[k] <= LEAST_GAIN * s * s / n:
            continue
        left = tree.add(float(best.left_count[k]), float(best.left_sum[k]))
        right = tree.add(float(n - best.left_count[k]), float(s - best.left_sum[k]))
        feature[k] = tree.feature[node] = int(draws[k, best.feature[k]])
        tree.left[node], tree.right[node], tree.goes_left[node], tree.gain[node] = left, right, best.goes_left[k], float(gain)
        following[k] = np.where(best.goes_left[k], len(grown), len(grown) + 1)
        grown += [left, right]
    return (feature, following), grown


def _moving(moves: dict[int, tuple[np.ndarray, np.ndarray]]):
    def move(found: Iterable[Block]) -> Iterator[Block]:
        for codes, truth, drawn, place in found:
            n, flat, moved = len(truth), codes.reshape(-1), np.full_like(place, -1)
            for k, (feature, following) in moves.items():
                for low in range(0, n, CHUNK):
                    own = place[k, low : low + CHUNK].astype(np.intp)
                    # A row at no growing node has place -1, the last line of the table, which leads nowhere.
                    own[own < 0] = len(feature) - 1
                    at = feature.take(own)
                    at *= n
                    at += np.arange(low, low + len(own))
                    own *= following.shape[1]
                    own += flat.take(at)
                    moved[k, low : low + CHUNK] = following.reshape(-1).take(own)
            yield codes, truth, drawn, moved

    return move
