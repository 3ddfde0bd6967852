"""Explicit schemas for every boundary of the pipeline.

Nothing is inferred: an undeclared input field is ignored and a missing
required column is an error at analysis time.
"""

from pyspark.sql import types as T

# Field names and types of the raw listing documents.
LISTING_RAW = T.StructType(
    [
        T.StructField("propertyCode", T.StringType()),
        T.StructField("propertyType", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("rooms", T.LongType()),
        T.StructField("bathrooms", T.LongType()),
        T.StructField("municipality", T.StringType()),
        T.StructField("neighborhood", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("hasLift", T.BooleanType()),
        T.StructField("exterior", T.BooleanType()),
        T.StructField("status", T.StringType()),
        T.StructField("distance", T.StringType()),
        T.StructField("floor", T.StringType()),
        T.StructField("externalReference", T.StringType()),
        T.StructField("priceByArea", T.DoubleType()),
        T.StructField("numPhotos", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("thumbnail", T.StringType()),
        T.StructField("showAddress", T.BooleanType()),
        T.StructField("hasVideo", T.BooleanType()),
        T.StructField("newDevelopment", T.BooleanType()),
        T.StructField("hasPlan", T.BooleanType()),
        T.StructField("has3DTour", T.BooleanType()),
        T.StructField("has360", T.BooleanType()),
        T.StructField("hasStaging", T.BooleanType()),
        T.StructField("topNewDevelopment", T.BooleanType()),
        T.StructField(
            "detailedType",
            T.StructType(
                [
                    T.StructField("typology", T.StringType()),
                    T.StructField("subTypology", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "suggestedTexts",
            T.StructType(
                [
                    T.StructField("title", T.StringType()),
                    T.StructField("subtitle", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "parkingSpace",
            T.StructType(
                [
                    T.StructField("hasParkingSpace", T.BooleanType()),
                    T.StructField("isParkingSpaceIncludedInPrice", T.BooleanType()),
                    T.StructField("parkingSpacePrice", T.DoubleType()),
                ]
            ),
        ),
    ]
)

# Headers of the yearly income file (all text).
INCOME_RAW = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "Any",
            "Codi_Districte",
            "Nom_Districte",
            "Codi_Barri",
            "Nom_Barri",
            "Import_Euros",
        )
    ]
)

# Fields of the yearly density documents that are used.
DENSITY_RAW = T.StructType(
    [
        T.StructField("Any", T.StringType()),
        T.StructField("Nom_Barri", T.StringType()),
        T.StructField("Densitat (hab/ha)", T.StringType()),
    ]
)

# Headers of the area lookup files (all text).
AREA_LOOKUP = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "district",
            "neighborhood",
            "district_n_reconciled",
            "district_n",
            "district_id",
            "neighborhood_n_reconciled",
            "neighborhood_n",
            "neighborhood_id",
        )
    ]
)

# The published gold columns.
GOLD = T.StructType(
    [
        T.StructField("bathrooms", T.IntegerType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("district", T.StringType()),
        T.StructField("exterior", T.BooleanType()),
        T.StructField("hasLift", T.BooleanType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("neighborhood", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("propertyType", T.StringType()),
        T.StructField("rooms", T.IntegerType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("avg_income_index", T.DoubleType()),
        T.StructField("density_val", T.DoubleType()),
        T.StructField("price_m2", T.DoubleType()),
        T.StructField("pipeline_execution_date", T.StringType()),
    ]
)

# The scoring request record.
VALUATION_REQUEST = T.StructType(
    [
        T.StructField("size", T.DoubleType()),
        T.StructField("rooms", T.IntegerType()),
        T.StructField("bathrooms", T.IntegerType()),
        T.StructField("neighborhood", T.StringType()),
        T.StructField("propertyType", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("avg_income_index", T.DoubleType()),
        T.StructField("density_val", T.DoubleType()),
    ]
)

# Model inputs and target.
NUMERIC_FEATURES = ["size", "rooms", "bathrooms", "avg_income_index", "density_val"]
CATEGORICAL_FEATURES = ["neighborhood", "propertyType", "district"]
TARGET = "price"

RUN = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("mape", T.DoubleType()),
        T.StructField("residual_mean", T.DoubleType()),
        T.StructField("residual_std", T.DoubleType()),
        T.StructField("n_samples", T.LongType()),
        T.StructField("pred_min", T.DoubleType()),
        T.StructField("pred_max", T.DoubleType()),
        T.StructField("pred_mean", T.DoubleType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("finished_at", T.TimestampType()),
    ]
)
