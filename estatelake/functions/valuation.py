"""Columns shown next to a predicted price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelake.functions.numbers import not_negative, ratio

# Upper floor of each band; ground is floor 0 alone and
# anything above the last bound is the top band.
FLOOR_BANDS = [("low", 2), ("mid", 5), ("high", 10)]
GROUND_BAND = "ground"
TOP_BAND = "penthouse"

# Fixed value: half width of the displayed range around the estimate.
CARD_RANGE = 0.10


def floor_band(floor: Column) -> Column:
    """Band of a floor number; floors below ground count as low."""
    band = F.when(floor == 0, GROUND_BAND)
    for name, top in FLOOR_BANDS:
        band = band.when(floor <= top, name)
    return band.when(floor.isNotNull(), TOP_BAND)


def card_columns(prediction: Column, size: Column, width: float = CARD_RANGE) -> dict[str, Column]:
    """Range and price per area of a positive estimate, nulls otherwise."""
    shown = F.when(prediction > 0, prediction)
    return {
        "card_low": shown * F.lit(1 - width),
        "card_high": shown * F.lit(1 + width),
        "predicted_m2": ratio(shown, size),
    }


def error_band(prediction: Column, rmse: Column) -> dict[str, Column]:
    """Interval of one RMSE either side, never below zero."""
    return {
        "confidence_low": not_negative(prediction - rmse),
        "confidence_high": not_negative(prediction + rmse),
    }


def interval_of(outputs: Column, probability: float) -> Column:
    """Percentile of an array of ensemble outputs, linear between neighbours."""
    return percentile_of_sorted(F.sort_array(outputs), probability)


def percentile_of_sorted(ordered: Column, probability: float) -> Column:
    position = (F.size(ordered) - 1) * F.lit(probability)
    low = F.floor(position).cast("int")
    high = F.ceil(position).cast("int")
    below = F.get(ordered, low)
    return below + (F.get(ordered, high) - below) * (position - low)
