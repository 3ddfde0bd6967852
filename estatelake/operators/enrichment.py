"""Yearly area statistics and their join to listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.numbers import ratio, mean_of

AREA_YEAR = ["neighborhood_id", "year"]
STATISTICS = ["avg_income_index", "density_val"]


def income_index(income: DataFrame) -> DataFrame:
    """Mean income per area and year; an area without any amount keeps a null."""
    return (
        income.dropna(subset=AREA_YEAR)
        .groupBy(*AREA_YEAR)
        .agg(mean_of("income").alias("avg_income_index"))
    )


def density_max(density: DataFrame) -> DataFrame:
    return (
        density.dropna(subset=[*AREA_YEAR, "density_val"])
        .groupBy(*AREA_YEAR)
        .agg(F.max("density_val").alias("density_val"))
    )


def area_statistics(income: DataFrame, density: DataFrame) -> DataFrame:
    """One row per area and year that has income, with density where known.

    Joining the two small sides first leaves a single join on the listings,
    which a hot area can only skew once and which the planner may split.
    """
    return income_index(income).join(density_max(density), AREA_YEAR, "left")


def enrich(listings: DataFrame, areas: DataFrame, how: str = "inner") -> DataFrame:
    """Listings with the statistics of their own area and year."""
    return listings.join(areas, AREA_YEAR, how)


def with_price_per_area(df: DataFrame) -> DataFrame:
    return df.withColumn("price_m2", ratio("price", "size"))
