"""Exact quantiles of a column of any size.

The values are reduced to distinct (value, count) pairs, which spreads over the
cluster and absorbs repeated values, and a wanted rank is bracketed between
splitters until the bracket is small enough to sort.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.staging import staged

# Distinct values of a bracket that one task puts in order.
BRACKET = 100_000
SPLITTERS = 32
SKETCH_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], bracket: int = BRACKET
) -> dict[str, list[float | None]]:
    """Interpolated quantiles (rank ``(n-1)*p``) per column; nulls and NaNs are ignored.

    The input is evaluated once for each column; what follows reads the written counts.
    """
    return {c: _quantiles(df, c, probabilities, bracket) for c in columns}


def _quantiles(df: DataFrame, column: str, probabilities: list[float], bracket: int) -> list[float | None]:
    number = F.col(column).cast("double")
    values = df.select(number.alias("v")).where("v is not null and not isnan(v)")
    with staged(values.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "counts") as counts:
        total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
        if not total:
            return [None] * len(probabilities)
        positions = [(total - 1) * p for p in probabilities]
        ranks = sorted({r for p in positions for r in (math.floor(p), math.ceil(p))})
        at = _values_at_ranks(counts, distinct, ranks, bracket)
    result = []
    for p in positions:
        low, high = math.floor(p), math.ceil(p)
        result.append(at[low] if low == high else (high - p) * at[low] + (p - low) * at[high])
    return result


def approx_quantiles(
    df: DataFrame, column: str, probabilities: list[float], relative_error: float = 0.01
) -> list[float | None]:
    """Quantiles whose rank is off by at most ``relative_error`` of the rows."""
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    accuracy = F.lit(round(1 / relative_error))
    found = df.agg(F.percentile_approx(F.col(column).cast("double"), wanted, accuracy)).first()[0]
    return list(found) if found is not None else [None] * len(probabilities)


def _values_at_ranks(
    counts: DataFrame, distinct: int, ranks: list[int], bound: int
) -> dict[int, float]:
    """Values at zero-based ranks of the multiset ``counts(v, n)``."""
    if distinct <= bound:
        return _values_in_order(counts, ranks)
    # The sketch runs over distinct values, so each part between two cuts holds
    # about 1/SPLITTERS of them however often a value repeats.
    shares = F.array(*[F.lit(i / SPLITTERS) for i in range(1, SPLITTERS)])
    cuts = counts.agg(F.percentile_approx("v", shares, F.lit(SKETCH_ACCURACY))).first()[0]
    cuts = sorted(set(cuts))
    row = counts.agg(
        *[F.sum(F.when(F.col("v") <= c, F.col("n")).otherwise(0)) for c in cuts],
        *[F.count_if(F.col("v") <= c) for c in cuts],
        F.sum("n"),
    ).first()
    rows_upto, distinct_upto = list(row[: len(cuts)]), list(row[len(cuts) : -1])
    edges = [None, *cuts, None]
    rows_upto, distinct_upto = [0, *rows_upto, row[-1]], [0, *distinct_upto, distinct]
    found: dict[int, float] = {}
    for i in range(len(edges) - 1):
        inside = [r for r in ranks if rows_upto[i] <= r < rows_upto[i + 1]]
        if not inside:
            continue
        part = counts
        if edges[i] is not None:
            part = part.where(F.col("v") > edges[i])
        if edges[i + 1] is not None:
            part = part.where(F.col("v") <= edges[i + 1])
        size, before = distinct_upto[i + 1] - distinct_upto[i], rows_upto[i]
        below = _values_at_ranks(part, size, [r - before for r in inside], bound)
        found |= {r: below[r - before] for r in inside}
    return found


def _values_in_order(counts: DataFrame, ranks: list[int]) -> dict[int, float]:
    """The same for a part that was counted and is small enough for one task."""
    ordered = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("upto", F.sum("n").over(ordered))
    row = running.agg(*[F.min(F.when(F.col("upto") > r, F.col("v"))) for r in ranks]).first()
    return dict(zip(ranks, row))
