"""Bulk valuation: requests in, prices with intervals out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.valuation import card_columns, floor_band
from estatelake.operators import areas, models, requests
from estatelake.operators.cleaning import with_area_id

# Fixed value: currency of all prices.
CURRENCY = "EUR"


def value(
    raw_requests: DataFrame,
    model: PipelineModel,
    rmse: float,
    model_version: str,
    measures: DataFrame | None = None,
    districts: DataFrame | None = None,
    lookup: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(responses, quarantined requests); every request is in one of them.

    With ``measures``, ``districts`` and ``lookup`` given, income and density
    come from the area tables instead of the request.  Extra request columns
    pass through.
    """
    typed = requests.with_defaults(raw_requests)
    if measures is not None:
        located = with_area_id(typed.drop("avg_income_index", "density_val"), lookup)
        typed = areas.with_area_measures(located, measures, districts)
    accepted, rejected = requests.split_valid(requests.validate_rows(typed))
    scored, gaps = models.score_or_reject(accepted, model, rmse)
    return responses(scored, model_version), rejected.unionByName(gaps.withColumnRenamed("reasons", "failed_rules"))


def responses(scored: DataFrame, model_version: str) -> DataFrame:
    """Response columns: rounded money, currency, version, card and floor band."""
    card = card_columns(F.col("predicted_price"), F.col("size"))
    out = scored.withColumns(card).withColumns(models.rounded_prices())
    if "floor" in scored.columns:
        out = out.withColumn("floor_category", floor_band(F.col("floor")))
    return out.withColumns({"currency": F.lit(CURRENCY), "model_version": F.lit(model_version)})
