"""Boosted trees of several settings and folds, grown side by side.

Spark's own boosting runs jobs for each level of each tree of each fit, which at many fits is mostly
waiting.  Here all fits share the jobs: one for each level of a tree.  The rows lie as blocks of bins in
the executors' memory, with what the trees so far give for each row and fit.  A job adds up, block by block,
what all fits need of a level (counts and sums by node and bin), the driver adds these tables and picks the splits.
The trees are those of Spark's ``GBTRegressor`` for squared errors: the first fits the target,
each later one twice the residuals, weighted by the step size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame

from estatelake.folders import remove_folder
from estatelake.operators.binned import Layout, best_splits

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that a task takes at least, rows that it works on at once, bytes that it sends.
TASK_ROWS = 20_000
CHUNK = 1 << 14
MESSAGE_BYTES = 1 << 22
# A gain counts from this share of a node's squared sum; less is rounding.
LEAST_GAIN = 1e-12
# Trees between two checkpoints of the rows' sums, if the session has a folder for them.
CHECKPOINT_TREES = 20


@dataclass(frozen=True)
class Boosting:
    """Settings of one boosted fit to all rows but those of the fold ``held``."""

    length: int
    depth: int
    step: float
    least_rows: int = 1
    least_gain: float = 0.0
    held: int | None = None

    @classmethod
    def of(cls, estimator: GBTRegressor, held: int | None = None) -> Boosting:
        e = estimator
        return cls(e.getMaxIter(), e.getMaxDepth(), e.getStepSize(), e.getMinInstancesPerNode(), e.getMinInfoGain(), held)

    def message_bytes(self, layout: Layout) -> int:
        return 16 * sum(layout.bins) * 2 ** max(0, self.depth - 2)


@dataclass
class Tree:
    """Nodes of a tree, parents before children; a leaf has no feature (-1)."""

    feature: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    goes_left: list[np.ndarray | None] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    count: list[float] = field(default_factory=list)
    sum: list[float] = field(default_factory=list)
    squares: list[float] = field(default_factory=list)

    def add(self, count: float, total: float) -> int:
        for column, value in zip(vars(self).values(), (-1, -1, -1, None, -1.0, count, total, 0.0)):
            column.append(value)
        return len(self.feature) - 1


def grows_here(estimator) -> bool:
    """Whether the estimator's trees are plain enough for this module."""
    return (
        isinstance(estimator, GBTRegressor) and estimator.getSubsamplingRate() == 1.0 and estimator.getFeatureSubsetStrategy() in ("all", "auto")
        and estimator.getLossType() == "squared" and estimator.getMinWeightFractionPerNode() == 0.0 and estimator.getMaxDepth() > 0
        and not estimator.isDefined("weightCol") and not estimator.isDefined("validationIndicatorCol")
    )


# A block of rows: fold, bins (feature by feature), targets, and for each fit what its trees give so far (None: held out).
Block = tuple[int, np.ndarray, np.ndarray, list[np.ndarray | None]]


@dataclass(frozen=True)
class Ask:
    """What a level of a tree needs of the rows: how they walk to their nodes, and which nodes are asked for what.

    ``slot`` and ``place`` number the nodes whose counts and sums by bin, or whose sums of squares are wanted; -1 for others.
    """

    fit: int
    feature: np.ndarray
    following: np.ndarray
    levels: int
    scale: float
    slot: np.ndarray
    place: np.ndarray

    def nodes(self, codes: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """The node of each row, by chunks."""
        n, width, flat, following = codes.shape[1], self.following.shape[1], codes.reshape(-1), self.following.reshape(-1)
        for low in range(0, n, CHUNK):
            here = slice(low, min(n, low + CHUNK))
            at = np.zeros(here.stop - low, np.intp)
            rows = np.arange(low, here.stop)
            for _ in range(self.levels):
                place = self.feature.take(at)
                place *= n
                place += rows
                at *= width
                at += flat.take(place)
                at = following.take(at)
            yield here, at

    def sums(self, block: Block, bins: list[int]) -> np.ndarray:
        _, codes, truth, so_far = block
        slots, places = int(self.slot.max()) + 1, int(self.place.max()) + 1
        sizes = [slots * b for b in bins]
        counts, sums, squares = [np.zeros(m) for m in sizes], [np.zeros(m) for m in sizes], np.zeros(places + 1)
        for here, at in self.nodes(codes):
            goal = self.scale * (truth[here] - so_far[self.fit][here])
            if places:
                squares += np.bincount(self.place.take(at) + 1, goal * goal, places + 1)
            if not slots:
                continue
            own, rows = self.slot.take(at), None
            if self.levels:
                rows = np.flatnonzero(own >= 0)
                own, goal = own.take(rows), goal.take(rows)
            for k, (b, size) in enumerate(zip(bins, sizes)):
                part = codes[k, here]
                key = own * b
                key += part if rows is None else part.take(rows)
                counts[k] += np.bincount(key, minlength=size)
                sums[k] += np.bincount(key, goal, size)
        return np.concatenate([*counts, *sums, squares[1:]])


def boost(blocks: DataFrame, rows: int, layout: Layout, fits: list[Boosting], exact: bool = False) -> list[list[Tree]]:
    """The trees of every fit, from ``rows`` rows as blocks of bins and targets (see ``binned``).

    Fits run side by side as far as their tables are small.  With ``exact`` the nodes have
    their sums of squares as well.
    """
    groups: list[list[Boosting]] = []
    for fit in fits:
        used = sum(f.message_bytes(layout) for f in groups[-1]) if groups else 0
        if not groups or used + fit.message_bytes(layout) > MESSAGE_BYTES:
            groups.append([])
        groups[-1].append(fit)
    return [trees for group in groups for trees in _boost_together(blocks, rows, layout, group, exact)]


def _boost_together(blocks: DataFrame, rows: int, layout: Layout, fits: list[Boosting], exact: bool) -> list[list[Tree]]:
    context = blocks.sparkSession.sparkContext
    tasks = min(context.defaultParallelism, max(1, rows // TASK_ROWS))
    size, dtype, bins, held = len(layout.kinds), layout.dtype, layout.bins, [f.held for f in fits]

    def load(found: Iterable) -> Iterator[Block]:
        for fold, codes, target in found:
            truth = np.frombuffer(target, np.float64)
            yield fold, np.frombuffer(codes, dtype).reshape(size, -1), truth, [None if fold == h else np.zeros(len(truth)) for h in held]

    state, before = _kept(blocks.select("fold", "codes", "target").repartition(tasks).rdd.mapPartitions(load)), None
    drafts, checkpoints = [_Fit(k, f, layout, exact) for k, f in enumerate(fits)], []
    for k in range(max(f.length for f in fits)):
        growing = [d for d in drafts if k < d.fit.length]
        for d in growing:
            d.begin()
        while asking := [d for d in growing if d.frontier]:
            for d, part in zip(asking, _summed(state, [d.ask() for d in asking], bins, [d.message() for d in asking], held)):
                d.split(part)
            if before is not None:
                # The first level of this tree was the job that moved the rows on.
                before.unpersist()
                before = None
        if k + 1 < max(f.length for f in fits):
            before, state = state, _moved_on(state, [(d.ask(), d.outputs()) for d in growing if k + 1 < d.fit.length])
            if (k + 1) % CHECKPOINT_TREES == 0 and context.getCheckpointDir() is not None:
                state.checkpoint()
                checkpoints.append(state)
    state.unpersist()
    for written in checkpoints:
        if path := written.getCheckpointFile():
            remove_folder(blocks.sparkSession, path)
    return [d.trees for d in drafts]


def _kept(state: RDD) -> RDD:
    return state.persist(StorageLevel.MEMORY_AND_DISK)


def _summed(state: RDD, asks: list[Ask], bins: list[int], sizes: list[int], held: list[int | None]) -> list[np.ndarray]:
    """The tables that the fits ask for, added over all rows."""

    def add(found: Iterable[Block]) -> Iterator[np.ndarray]:
        total = [np.zeros(n) for n in sizes]
        for block in found:
            for ask, own in zip(asks, total):
                if block[0] != held[ask.fit]:
                    own += ask.sums(block, bins)
        yield np.concatenate(total)

    whole = np.zeros(sum(sizes))
    for part in state.mapPartitions(add).collect():
        whole += part
    return np.split(whole, np.cumsum(sizes)[:-1])


def _moved_on(state: RDD, grown: list[tuple[Ask, np.ndarray]]) -> RDD:
    """The rows with the new trees added to what each fit gives."""

    def add(found: Iterable[Block]) -> Iterator[Block]:
        for fold, codes, truth, so_far in found:
            for ask, outputs in grown:
                if so_far[ask.fit] is not None:
                    own = so_far[ask.fit]
                    for here, at in ask.nodes(codes):
                        own[here] += outputs.take(at)
            yield fold, codes, truth, so_far

    return _kept(state.mapPartitions(add))


class _Fit:
    """The trees of a fit, and of the one that grows the nodes of its last level."""

    def __init__(self, number: int, fit: Boosting, layout: Layout, exact: bool):
        self.number, self.fit, self.exact = number, fit, exact
        self.bins, self.kinds, self.widest = layout.bins, layout.kinds, max(layout.bins)
        self.trees: list[Tree] = []

    def begin(self) -> None:
        self.trees.append(Tree())
        self.trees[-1].add(0.0, 0.0)
        # The nodes to split, and those of them whose tables are asked for: the other child is what is left of its parent.
        self.level, self.frontier, self.sent = 0, [0], [0]
        self.known: dict[int, list[np.ndarray]] = {}

    @property
    def grows(self) -> bool:
        return self.level < self.fit.depth

    def message(self) -> int:
        return 2 * len(self.sent) * sum(self.bins) * self.grows + len(self.frontier) * self.exact

    def ask(self) -> Ask:
        tree = self.trees[-1]
        nodes = len(tree.feature)
        slot, place = np.full(nodes, -1), np.full(nodes, -1)
        if self.grows:
            slot[self.sent] = np.arange(len(self.sent))
        if self.exact:
            place[self.frontier] = np.arange(len(self.frontier))
        following = np.repeat(np.arange(nodes), self.widest).reshape(nodes, self.widest)
        for node in range(nodes):
            if tree.feature[node] >= 0:
                following[node] = np.where(tree.goes_left[node], tree.left[node], tree.right[node])
        scale = 1.0 if len(self.trees) == 1 else 2.0
        return Ask(self.number, np.maximum(tree.feature, 0), following, self.level, scale, slot, place)

    def split(self, whole: np.ndarray) -> None:
        """Takes the sums over all rows, splits the nodes of this level and names those of the next."""
        tree = self.trees[-1]
        if self.exact:
            for node, q in zip(self.frontier, whole[len(whole) - len(self.frontier) :]):
                tree.squares[node] = float(q)
        if not self.grows:
            self.frontier = []
            return
        tables, low = [], 0
        for b in self.bins * 2:
            tables.append(whole[low : low + len(self.sent) * b].reshape(-1, b))
            low += len(self.sent) * b
        known = {node: [t[k] for t in tables] for k, node in enumerate(self.sent)}
        for parent in self.known:
            left, right = tree.left[parent], tree.right[parent]
            if left >= 0:
                sent, other = (left, right) if left in known else (right, left)
                known[other] = [a - b for a, b in zip(self.known[parent], known[sent])]
        self.known = known
        if self.level == 0:
            tree.count[0], tree.sum[0] = float(known[0][0].sum()), float(known[0][len(self.bins)].sum())
            if not tree.count[0]:
                raise ValueError(f"no rows to fit beside fold {self.fit.held}")
        stacked = [np.stack([known[node][k] for node in self.frontier]) for k in range(2 * len(self.bins))]
        n, s = (np.array([column[node] for node in self.frontier]) for column in (tree.count, tree.sum))
        best = best_splits(stacked[: len(self.bins)], stacked[len(self.bins) :], self.kinds, n, s, self.fit.least_rows)
        frontier, sent = [], []
        for k, node in enumerate(self.frontier):
            gain = best.gain[k] / n[k]
            if not gain > 0 or gain < self.fit.least_gain or best.gain[k] <= LEAST_GAIN * s[k] * s[k] / n[k]:
                continue
            left = tree.add(float(best.left_count[k]), float(best.left_sum[k]))
            right = tree.add(float(n[k] - best.left_count[k]), float(s[k] - best.left_sum[k]))
            tree.feature[node], tree.left[node], tree.right[node] = int(best.feature[k]), left, right
            tree.goes_left[node], tree.gain[node] = best.goes_left[k], float(gain)
            frontier += [left, right]
            sent.append(left if tree.count[left] <= tree.count[right] else right)
        self.level += 1
        self.frontier, self.sent = (frontier, sent) if self.exact or self.grows else ([], [])

    def outputs(self) -> np.ndarray:
        """What the finished tree adds for a row in each node."""
        tree = self.trees[-1]
        count = np.array(tree.count)
        means = np.divide(tree.sum, count, out=np.zeros(len(count)), where=count > 0)
        return means * (1.0 if len(self.trees) == 1 else self.fit.step)
