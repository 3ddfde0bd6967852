"""Area measures: latest values, merged sides and the fallback chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.numbers import mean_of


def latest_measure(df: DataFrame, key: str, value: str, year: str = "year") -> DataFrame:
    """Value of the greatest year per key."""
    return df.groupBy(key).agg(F.max_by(value, year).alias(value))


def merge_measures(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Both measures by key; either may be missing."""
    return left.join(right, key, "full_outer")


def area_catalog(df: DataFrame) -> DataFrame:
    """Distinct districts and their areas, in name order."""
    return df.select("district", "neighborhood").distinct().orderBy("district", "neighborhood")


def district_means(measures: DataFrame, lookup: DataFrame) -> DataFrame:
    """Mean income and density per district over its areas with an income."""
    areas = lookup.select("neighborhood_id", "district").distinct()
    known = measures.where("income > 0").join(areas, "neighborhood_id")
    return known.groupBy("district").agg(
        mean_of("income").alias("district_income"),
        mean_of("density_val").alias("district_density"),
    )


def with_area_measures(df: DataFrame, measures: DataFrame, districts: DataFrame) -> DataFrame:
    """Income and density of the own area, else its district, else the city.

    An own income of zero or less counts as missing.  A row with own income
    but no own density takes the density of the city.
    """
    city = measures.where("income > 0").agg(
        F.struct(
            mean_of("income").alias("income"),
            mean_of("density_val").alias("density"),
        ).alias("city")
    ).scalar()
    own = F.col("income") > 0
    area = F.col("district_income").isNotNull()
    filled = (
        df.join(measures.select("neighborhood_id", "income", "density_val"), "neighborhood_id", "left")
        .join(districts, "district", "left")
        .withColumn("_city", city)
    )
    return filled.withColumns(
        {
            "avg_income_index": F.when(own, F.col("income"))
            .when(area, F.col("district_income"))
            .otherwise(F.col("_city.income")),
            "area_density": F.when(own, F.coalesce("density_val", "_city.density"))
            .when(area, F.col("district_density"))
            .otherwise(F.col("_city.density")),
            "measure_source": F.when(own, "neighborhood").when(area, "district").otherwise("city"),
        }
    ).drop("income", "density_val", "district_income", "district_density", "_city").withColumnRenamed(
        "area_density", "density_val"
    )
