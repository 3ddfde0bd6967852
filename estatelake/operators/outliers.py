"""Sanity range, interquartile fences and the audit of removed rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.operators.quantiles import approx_quantiles, exact_quantiles

# Smallest plausible size and sale price (both exclusive), the
# quartiles and the fence factor.
MIN_SIZE = 15
MIN_PRICE = 10_000
LOW_QUARTILE = 0.25
HIGH_QUARTILE = 0.75
FENCE_FACTOR = 1.5


@dataclass(frozen=True)
class Fences:
    q1: float | None
    q3: float | None

    @property
    def lower(self) -> float | None:
        return None if self.q1 is None else self.q1 - FENCE_FACTOR * (self.q3 - self.q1)

    @property
    def upper(self) -> float | None:
        return None if self.q1 is None else self.q3 + FENCE_FACTOR * (self.q3 - self.q1)

    def holds(self, column: str) -> Column:
        value = F.col(column)
        return (value >= F.lit(self.lower).cast("double")) & (
            value <= F.lit(self.upper).cast("double")
        )


def iqr_fences(df: DataFrame, column: str, mode: str = "exact") -> Fences:
    """Quartiles of a column: ``exact``, or ``approx`` by a bounded sketch."""
    quartiles = [LOW_QUARTILE, HIGH_QUARTILE]
    if mode == "approx":
        return Fences(*approx_quantiles(df, column, quartiles))
    return Fences(*exact_quantiles(df, [column], quartiles)[column])


def iqr_filter(df: DataFrame, column: str, mode: str = "exact") -> DataFrame:
    """Rows within the fences, bounds included; nulls are dropped."""
    return df.where(iqr_fences(df, column, mode).holds(column))


def plausible(size: str = "size", price: str = "price") -> Column:
    return (F.col(size) > MIN_SIZE) & (F.col(price) > MIN_PRICE)


def filter_audit(df: DataFrame, column: str, fences: Fences) -> DataFrame:
    """One row: how many rows came in and how many each filter removed."""
    sane = F.coalesce(plausible(), F.lit(False))
    inside = F.coalesce(fences.holds(column), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count_if(~sane).alias("n_implausible"),
        F.count_if(sane & ~inside).alias("n_outliers"),
        F.count_if(sane & inside).alias("n_kept"),
    )
