"""Bronze to silver: typed projections, area ids, de-duplication, yearly means."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelake.functions.numbers import (
    mean_of_parts,
    mean_of,
    total_of,
    to_boolean,
    to_double,
    to_int,
)


def typed_listings(raw: DataFrame) -> DataFrame:
    """Silver columns of raw listings; a value that does not parse is null."""
    return raw.withColumns(
        {
            "property_id": F.col("propertyCode"),
            "price": to_double("price"),
            "size": to_double("size"),
            "rooms": to_int("rooms"),
            "bathrooms": to_int("bathrooms"),
            "latitude": to_double("latitude"),
            "longitude": to_double("longitude"),
            "hasLift": to_boolean("hasLift"),
            "exterior": to_boolean("exterior"),
            "distance": to_double("distance"),
            "data_year": to_int("data_year"),
        }
    )


# Silver listing columns.
SILVER_LISTING = [
    "property_id",
    "propertyType",
    "price",
    "size",
    "rooms",
    "bathrooms",
    "municipality",
    "neighborhood",
    "neighborhood_id",
    "district",
    "latitude",
    "longitude",
    "hasLift",
    "exterior",
    "status",
    "distance",
    "data_year",
]


def clean_listings(
    raw: DataFrame, lookup: DataFrame, newest_first: list[Column], lineage: list[str] | None = None
) -> DataFrame:
    """One typed row per property, the newest, with its area id; rows without a property all stay.

    ``newest_first`` must order the copies of a property totally, or replays
    may keep different rows.  ``lineage`` names columns of the raw rows to keep.
    """
    newest = latest_per_key(typed_listings(raw), ["property_id"], newest_first)
    return with_area_id(newest, lookup).select(*SILVER_LISTING, *(lineage or []))


def clean_income(raw: DataFrame, lookup: DataFrame, years: DataFrame) -> DataFrame:
    """Mean income per area and year, for years that have listings."""
    typed = in_years(
        raw.withColumns({"year": to_int("Any"), "income": to_double("Import_Euros")}), years
    )
    mapped = with_area_id(typed, lookup, name_column="Nom_Barri").dropna(subset=["neighborhood_id"])
    named = mapped.withColumnsRenamed(
        {
            "Codi_Districte": "district_id",
            "Nom_Districte": "district_name",
            "Codi_Barri": "neighborhood_id_old",
            "Nom_Barri": "neighborhood_name",
        }
    )
    attributes = ["district_id", "district_name", "neighborhood_id_old", "neighborhood_name"]
    return mean_by_area_year(named, "income", attributes)


def mean_by_area_year(df: DataFrame, value: str, attributes: list[str]) -> DataFrame:
    """Mean of a value per area and year, with the least of each text attribute.

    Least texts alone would sort all rows, since a text cannot be updated in a
    hash aggregation.  So rows are first summed per distinct set of attributes,
    and only those few sums are reduced to one row per area and year.
    """
    keys = ["neighborhood_id", "year"]
    parts = df.groupBy(*keys, *attributes).agg(
        total_of(value).alias("_total"), F.count(value).alias("_count")
    )
    return parts.groupBy(*keys).agg(
        *[F.min(a).alias(a) for a in attributes],
        mean_of_parts(F.sum("_total"), F.sum("_count")).alias(value),
    )


def clean_density(raw: DataFrame, lookup: DataFrame, years: DataFrame) -> DataFrame:
    """Mean density per area and year, for years that have listings."""
    typed = in_years(
        raw.withColumns({"year": to_int("Any"), "density_val": to_double("Densitat (hab/ha)")}),
        years,
    )
    mapped = with_area_id(typed, lookup, name_column="Nom_Barri").dropna(subset=["neighborhood_id"])
    return mapped.groupBy("neighborhood_id", "year").agg(
        mean_of("density_val").alias("density_val")
    )


def with_area_id(
    df: DataFrame, lookup: DataFrame, name_column: str = "neighborhood", id_column: str = "neighborhood_id"
) -> DataFrame:
    """Left join of the canonical area id by raw area name.

    Carries no broadcast hint: the planner broadcasts the lookup when its
    size on storage is under the session's threshold.
    """
    ids = area_ids(lookup, id_column).withColumnRenamed("neighborhood", name_column)
    return df.join(ids, name_column, "left")


def area_ids(lookup: DataFrame, id_column: str = "neighborhood_id") -> DataFrame:
    """One id for each area name, the least, so that no join on it repeats a row.

    ``duplicate_keys`` tells which names are listed more than once.
    """
    return lookup.groupBy("neighborhood").agg(F.min(id_column).alias(id_column))


def lookup_misses(df: DataFrame, lookup: DataFrame, name_column: str = "neighborhood") -> DataFrame:
    """Area names without an id and how many rows carry each.

    Counts come first, so the join handles one row per name.
    """
    names = df.groupBy(name_column).agg(F.count(F.lit(1)).alias("n_rows"))
    known = lookup.select(F.col("neighborhood").alias(name_column))
    return names.join(known, name_column, "left_anti")


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The first row of each key in the given order; rows without a whole key all stay.

    A rank filter of 1 lets the planner keep one row per key and map task
    before the shuffle, so a key with very many copies stays cheap.  A row without a
    whole key ranks alone.
    """
    whole = reduce(lambda both, key: both & F.col(key).isNotNull(), keys, F.lit(True))
    alone = F.when(~whole, F.monotonically_increasing_id())
    order = Window.partitionBy(*keys, "_alone").orderBy(*newest_first)
    ranked = df.withColumn("_alone", alone).withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").drop("_rank", "_alone")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def listing_years(listings: DataFrame) -> DataFrame:
    return listings.select(F.col("data_year").alias("year")).where("year is not null").distinct()


def in_years(df: DataFrame, years: DataFrame, year_column: str = "year") -> DataFrame:
    """Rows whose year occurs in ``years(year)``."""
    return df.join(years.select(F.col("year").alias(year_column)), year_column, "left_semi")


def in_segment(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value)


def date_columns_to_timestamps(df: DataFrame) -> DataFrame:
    """Dates become timestamps at midnight, without a time zone."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in dates})


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all keys present, rows to quarantine)."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return df.where(complete), df.where(~complete)
