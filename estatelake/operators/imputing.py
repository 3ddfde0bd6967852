"""Filling of missing values with constants, means and medians."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.numbers import to_double
from estatelake.operators.quantiles import exact_quantiles

# Fixed value: category of rows without one.
UNKNOWN = "Unknown"


def impute_mean(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Nulls become the mean of the column; an all-null column stays null.

    The means are one scalar subquery inside the plan, nothing is collected.  ``fit_on`` has
    the rows that the means are of, the table itself if it is not given.
    """
    means = (df if fit_on is None else fit_on).agg(
        F.struct(*[F.avg(c).alias(c) for c in columns]).alias("means")
    ).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), means.getField(c)) for c in columns})


def impute_value(df: DataFrame, value, columns: list[str]) -> DataFrame:
    return df.na.fill(value, subset=columns)


def impute_flag(df: DataFrame, columns: list[str]) -> DataFrame:
    """A missing flag means the feature is absent."""
    return impute_value(df, False, columns)


def impute_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    return impute_value(df, UNKNOWN, columns)


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Median of each column, text coerced to numbers first."""
    numbers = df.select(*[to_double(c).alias(c) for c in columns])
    return {c: found[0] for c, found in exact_quantiles(numbers, columns, [0.5]).items()}


def impute_median(df: DataFrame, columns: list[str], fitted: dict[str, float | None] | None = None) -> DataFrame:
    """Nulls and unparsable text become the median.

    Pass ``fitted`` to use medians of another table, such as the train part.
    """
    fill = medians(df, columns) if fitted is None else fitted
    return df.withColumns(
        {c: F.coalesce(to_double(c), F.lit(fill[c]).cast("double")) for c in columns}
    )
