"""Feature vectors as bins: all rows of a train part as blocks of small integers, for trees grown over all of them.

The bins are those of Spark's trees: a category is a bin, a number has a bin for each value or,
with more values than bins, quantiles as bins; the values of all rows count, none are drawn.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.operators.tree_arrays import elements

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a block.
BLOCK_ROWS = 1 << 16
# Distinct values of a number that a task counts, rows that it takes together for it, points that stand for more values.
VALUES = 8192
ROWS_COUNTED = 1 << 18
POINTS = 4096

BLOCK = "fold int, n int, codes binary, target binary"


@dataclass(frozen=True)
class Layout:
    """The bins of each feature: ``kinds`` categories, or (0) what lies between the thresholds of a number."""

    kinds: list[int]
    thresholds: list[np.ndarray]

    @property
    def bins(self) -> list[int]:
        return [k or len(t) + 1 for k, t in zip(self.kinds, self.thresholds)]

    @property
    def dtype(self):
        return np.uint8 if max(self.bins) <= 256 else np.uint16 if max(self.bins) <= 65536 else np.int32

    def codes(self, matrix: np.ndarray) -> np.ndarray:
        """The bin of each value, one row for each feature; ``matrix`` has a row for each row."""
        found = np.empty(matrix.shape[::-1], self.dtype)
        for k, (kind, thresholds) in enumerate(zip(self.kinds, self.thresholds)):
            found[k] = matrix[:, k] if kind else np.searchsorted(thresholds, matrix[:, k])
        return found


def fit_layout(rows: DataFrame, features: str, size: int, bins: int) -> Layout:
    """Bins for a vector column of ``size`` elements, from all rows."""
    kinds = [0] * size
    for kind in ("nominal", "binary"):
        for known in rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).get(kind, []):
            kinds[known["idx"]] = len(known.get("vals", [])) or known.get("num_vals", 2 if kind == "binary" else 0)
    numbers = [k for k in range(size) if not kinds[k]]
    found = {k: np.empty(0) for k in range(size)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        known = {k: (np.empty(0), np.empty(0)) for k in numbers}
        for matrix in _together(batches, ROWS_COUNTED):
            for place, k in enumerate(numbers):
                known[k] = summed(*[np.concatenate(pair) for pair in zip(known[k], (matrix[place], np.ones(matrix.shape[1])))])
        parts = [pa.record_batch([np.full(len(v), k, np.int32), v, n], ["feature", "value", "n"]) for k, (v, n) in known.items()]
        yield from parts

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        values, counts = np.unique(group["value"], return_inverse=True)
        found = thresholds_of(values, np.bincount(counts, group["n"], len(values)), bins - 1)
        return pd.DataFrame({"feature": [group["feature"].iloc[0]], "thresholds": [found]})

    if numbers:
        values = [column for k, column in enumerate(elements(features, size)) if k in numbers]
        counted = rows.select(*values).mapInArrow(count, "feature int, value double, n double")
        for r in counted.groupBy("feature").applyInPandas(merge, "feature int, thresholds array<double>").collect():
            found[r["feature"]] = np.array(r["thresholds"], np.float64)
    return Layout(kinds, [found[k] for k in range(size)])


def _together(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[np.ndarray]:
    """Columns as rows of a matrix, of about ``most`` rows at once."""
    held, n = [], 0
    for batch in batches:
        held.append(np.vstack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        n += batch.num_rows
        if n >= most:
            yield np.concatenate(held, axis=1)
            held, n = [], 0
    if n:
        yield np.concatenate(held, axis=1)


def summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts; of very many values, points of equal weight."""
    distinct, place = np.unique(values, return_inverse=True)
    total = np.bincount(place, counts, len(distinct))
    if len(distinct) <= VALUES:
        return distinct, total
    ends = np.cumsum(total)
    middle = np.searchsorted(ends, (np.arange(POINTS) + 0.5) * ends[-1] / POINTS)
    points, place = np.unique(distinct[middle], return_inverse=True)
    return points, np.bincount(place, minlength=len(points)) * ends[-1] / POINTS


def thresholds_of(values: np.ndarray, counts: np.ndarray, most: int) -> list[float]:
    """The thresholds that Spark's trees have for these values: between all of them, or at most ``most`` at equal strides."""
    if len(values) < 2:
        return []
    between = (values[1:] + values[:-1]) / 2
    if len(between) <= most:
        return [float(x) for x in between]
    found, stride = [], counts.sum() / (most + 1)
    target, so_far = stride, counts[0]
    for k in range(1, len(values)):
        before, so_far = so_far, so_far + counts[k]
        if abs(before - target) < abs(so_far - target):
            found.append(float(between[k - 1]))
            target += stride
    return found


def binned(rows: DataFrame, layout: Layout, features: str, target: str, fold: str) -> DataFrame:
    """Blocks of rows of one fold: their bins, feature by feature, and their targets."""
    columns = [F.col(fold).cast("int"), F.col(target).cast("double"), *elements(features, len(layout.kinds))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matrix in _together(batches, 2 * BLOCK_ROWS):
            for fold in np.unique(matrix[0]):
                own = matrix[:, matrix[0] == fold]
                for low in range(0, own.shape[1], BLOCK_ROWS):
                    part = own[:, low : low + BLOCK_ROWS]
                    blobs = [pa.array([x.tobytes()], pa.binary()) for x in (layout.codes(part[2:].T), part[1])]
                    yield pa.record_batch([pa.array([int(fold)], pa.int32()), pa.array([part.shape[1]], pa.int32()), *blobs], ["fold", "n", "codes", "target"])

    return rows.select(*columns).mapInArrow(cut, BLOCK)


@dataclass(frozen=True)
class Splits:
    """The best split of each node; ``gain`` is -inf where there is none, ``goes_left`` has a row of bins for each node."""

    feature: np.ndarray
    gain: np.ndarray
    left_count: np.ndarray
    left_sum: np.ndarray
    goes_left: np.ndarray


def best_splits(
    counts: list[np.ndarray], sums: list[np.ndarray], kinds: list[int | np.ndarray], n: np.ndarray, s: np.ndarray, least_rows: float
) -> Splits:
    """Splits of least squares, of (node, bin) counts and sums for each feature and those of the nodes.

    Where each node has features of its own, ``kinds`` has an array of them for each place.

    Categories are split in the order of their means, as Spark does; the first of equal splits wins.
    """
    nodes, widest = len(n), max(c.shape[1] for c in counts)
    found = Splits(np.zeros(nodes, np.int64), np.full(nodes, -np.inf), np.zeros(nodes), np.zeros(nodes), np.zeros((nodes, widest), bool))
    here, own = np.arange(nodes), np.divide(s * s, n, out=np.zeros(nodes), where=n > 0)
    for k, (c, t, kind) in enumerate(zip(counts, sums, kinds)):
        if c.shape[1] < 2:
            continue
        order = None
        with np.errstate(divide="ignore", invalid="ignore"):
            ranked = np.broadcast_to(np.asarray(kind) > 0, nodes)
            if ranked.any():
                order = np.tile(np.arange(c.shape[1]), (nodes, 1))
                order[ranked] = np.argsort(np.where(c > 0, t / c, np.inf)[ranked], axis=1, kind="stable")
                c, t = np.take_along_axis(c, order, 1), np.take_along_axis(t, order, 1)
            left, part = np.cumsum(c, axis=1)[:, :-1], np.cumsum(t, axis=1)[:, :-1]
            right, rest = n[:, None] - left, s[:, None] - part
            gain = part * part / left + rest * rest / right - own[:, None]
        gain[~((left >= least_rows) & (right >= least_rows))] = -np.inf
        gain[np.isnan(gain)] = -np.inf
        at = np.argmax(gain, axis=1)
        best = gain[here, at]
        better = best > found.gain
        if better.any():
            found.feature[better], found.gain[better] = k, best[better]
            found.left_count[better], found.left_sum[better] = left[here, at][better], part[here, at][better]
            goes = np.arange(c.shape[1])[None, :] <= at[:, None]
            if order is not None:
                in_order, goes = goes, np.empty_like(goes)
                np.put_along_axis(goes, order, in_order, 1)
            found.goes_left[better] = False
            found.goes_left[better, : c.shape[1]] = goes[better]
    return found
