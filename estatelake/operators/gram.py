"""Linear models from sums of products: one pass over the rows serves every fold and penalty.

A Gram table holds, for each fold, the sums of all products of two of (1, the features,
the target).  That is all a linear fit or its error needs, so:

* the rows outside of a fold are the total minus the fold, without another pass;
* each penalty of a grid is a small system of equations on the driver;
* the squared error on a fold follows from its own sums, so no fold is scored;
* tables of different rows add up: new rows cost a pass over themselves (``merged``).

The table has folds * (features + 2)**2 / 2 numbers, whatever the rows; it is meant for
some tens of features, as each sum is an aggregate of its own.  Sums of large numbers
with little spread lose digits, about twice the digits of mean over deviation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A pivot below this share of its column's own sum of squares counts as zero: the column follows from the others.
DEPENDENT = 1e-10
# The penalty of each coefficient, from the centred sums.
Penalty = Callable[["Sums"], np.ndarray]


def gram_table(rows: DataFrame, features: Sequence[str], target: str, by: str) -> DataFrame:
    """Rows (by, i, j, value) with i <= j; 0 is the constant 1, then the features, last the target.

    Rows with a gap (null or NaN) in any of them are left out.
    """
    names = [*features, target]
    numbers = rows.select(by, *[F.col(c).cast("double").alias(f"z{k + 1}") for k, c in enumerate(names)])
    whole = F.lit(True)
    for k in range(len(names)):
        whole &= F.col(f"z{k + 1}").isNotNull() & ~F.isnan(f"z{k + 1}")
    z = [F.lit(1.0), *[F.col(f"z{k + 1}") for k in range(len(names))]]
    pairs = list(combinations_with_replacement(range(len(z)), 2))
    sums = numbers.where(whole).groupBy(by).agg(*[F.sum(z[i] * z[j]).alias(f"s{i}_{j}") for i, j in pairs])
    cells = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s{i}_{j}").alias("value")) for i, j in pairs]
    return sums.select(by, F.inline(F.array(*cells)))


def vector_fields(rows: DataFrame, vector: str, size: int) -> tuple[DataFrame, list[str]]:
    """``rows`` with the elements of a vector column as columns of their own, and their names."""
    names = [f"{vector}_{k}" for k in range(size)]
    listed = rows.withColumn("_elements", vector_to_array(vector))
    return listed.select(*rows.columns, *[F.get("_elements", F.lit(k)).alias(n) for k, n in enumerate(names)]), names


def merged(*tables: DataFrame) -> DataFrame:
    """The Gram table of the rows of all tables."""
    both = tables[0]
    for table in tables[1:]:
        both = both.unionByName(table)
    by = both.columns[0]
    return both.groupBy(by, "i", "j").agg(F.sum("value").alias("value"))


class Sums:
    """The sums of products of some rows."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix

    @property
    def n(self) -> int:
        return int(round(self.matrix[0, 0]))

    def __sub__(self, other: Sums) -> Sums:
        return Sums(self.matrix - other.matrix)

    def centred(self) -> np.ndarray:
        """Sums of products of the deviations, features then target."""
        total = self.matrix[0, 1:]
        return self.matrix[1:, 1:] - total[:, None] * total / max(self.matrix[0, 0], 1.0)

    def target_deviation(self) -> float:
        return float(np.sqrt(max(self.centred()[-1, -1], 0.0) / max(self.n, 1)))

    def fit(self, penalties: np.ndarray) -> tuple[np.ndarray, float]:
        """Coefficients and intercept of least squared error plus ``penalties`` times squared coefficients."""
        products = self.centred()
        coefficients = solved(products[:-1, :-1] + np.diag(penalties), products[:-1, -1], np.diag(products)[:-1] + penalties)
        means = self.matrix[0, 1:] / max(self.matrix[0, 0], 1.0)
        return coefficients, float(means[-1] - (means[:-1] * coefficients).sum())

    def rmse(self, coefficients: np.ndarray, intercept: float) -> float:
        """Error of a fitted model on these rows."""
        line = np.concatenate([[intercept], coefficients, [-1.0]])
        squares = ((self.matrix * line).sum(axis=1) * line).sum()
        return float(np.sqrt(max(squares, 0.0) / self.n)) if self.n else float("nan")


def sums_by_fold(table: DataFrame) -> dict[int, Sums]:
    """The table's folds on the driver; its size does not depend on the rows."""
    cells = table.collect()
    size = max((c["j"] for c in cells), default=-1) + 1
    found: dict[int, np.ndarray] = {}
    for fold, i, j, value in cells:
        matrix = found.setdefault(fold, np.zeros((size, size)))
        matrix[i, j] = matrix[j, i] = value
    return {fold: Sums(matrix) for fold, matrix in sorted(found.items())}


def total_of(folds: dict[int, Sums]) -> Sums:
    return Sums(sum(s.matrix for s in folds.values()))


@dataclass(frozen=True)
class Fit:
    """A grid value fitted outside of a fold and judged on it."""

    value: float
    fold: int
    coefficients: np.ndarray
    intercept: float
    rmse: float
    n_fitted: int
    n_held: int


def search(folds: dict[int, Sums], penalties: dict[float, Penalty]) -> list[Fit]:
    """Every grid value on every fold."""
    every = total_of(folds)
    found = []
    for value, penalty in penalties.items():
        for fold, held in folds.items():
            rest = every - held
            coefficients, intercept = rest.fit(penalty(rest))
            found.append(Fit(value, fold, coefficients, intercept, held.rmse(coefficients, intercept), rest.n, held.n))
    return found


def ridge(alpha: float) -> Penalty:
    """``alpha`` adds to the plain sum of squares."""
    return lambda sums: np.full(len(sums.matrix) - 2, alpha)


def standardised(penalty: float) -> Penalty:
    """Spark's ``regParam`` on standardised features: mean squared errors, coefficients in units of deviations."""

    def of(sums: Sums) -> np.ndarray:
        spread = np.diag(sums.centred())[:-1]
        deviation = sums.target_deviation()
        return penalty * np.maximum(spread, 0.0) / deviation if deviation else np.zeros_like(spread)

    return of


def solved(matrix: np.ndarray, right: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The solution of a positive semidefinite system; a dependent column gets 0.

    Elimination by row operations: the systems are small, and threaded linear algebra
    must not be called on a driver that has forked.
    """
    n = len(right)
    work = np.column_stack([matrix, right]).astype(float)
    used = []
    for k in range(n):
        if work[k, k] <= DEPENDENT * max(scale[k], np.finfo(float).tiny):
            continue
        used.append(k)
        work[k] /= work[k, k]
        factors = work[:, k].copy()
        factors[k] = 0.0
        work -= factors[:, None] * work[k]
    found = np.zeros(n)
    found[used] = work[used, n]
    return found
