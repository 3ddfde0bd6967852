"""Scoring requests: defaults, rules and quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Type and default of every request field.
REQUEST_DEFAULTS = {
    "size": ("double", 0.0),
    "rooms": ("int", 0),
    "bathrooms": ("int", 0),
    "district": ("string", ""),
    "neighborhood": ("string", ""),
    "propertyType": ("string", "flat"),
    "has_parking": ("boolean", False),
    "has_lift": ("boolean", True),
    "has_ac": ("boolean", False),
    "floor": ("int", 1),
    "avg_income_index": ("double", 100.0),
    "density_val": ("double", 20000.0),
}

# Known property types and districts (checked on demand only).
PROPERTY_TYPES = ["flat", "studio", "chalet", "penthouse", "duplex", "countryHouse"]
DISTRICTS = [
    "Ciutat Vella",
    "Eixample",
    "Sants-Montjuïc",
    "Les Corts",
    "Sarrià-Sant Gervasi",
    "Gràcia",
    "Horta-Guinardó",
    "Nou Barris",
    "Sant Andreu",
    "Sant Martí",
]


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column


def request_rules() -> list[Rule]:
    # The accepted range of every request field.
    size, rooms, baths = F.col("size"), F.col("rooms"), F.col("bathrooms")
    return [
        Rule("size", (size > 0) & (size <= 2000)),
        Rule("rooms", (rooms >= 0) & (rooms <= 20)),
        Rule("bathrooms", (baths >= 1) & (baths <= 10)),
        Rule("neighborhood", F.length("neighborhood") >= 1),
        Rule("propertyType", F.col("propertyType").isNotNull()),
        Rule("district", F.col("district").isNotNull()),
        Rule("avg_income_index", _positive("avg_income_index")),
        Rule("density_val", _positive("density_val")),
    ]


def _positive(column: str) -> Column:
    # Spark orders NaN above every number, so the comparison alone lets it pass.
    return (F.col(column) > 0) & ~F.isnan(column)


def allowed_values(name: str, column: str, values: list[str]) -> Rule:
    return Rule(name, F.col(column).isin(values))


def validate_rows(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Adds ``failed_rules``; a rule on a null field fails."""
    checked = rules if rules is not None else request_rules()
    failed = [
        F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)) for rule in checked
    ]
    return df.withColumn("failed_rules", F.array_compact(F.array(*failed)))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted requests, quarantined requests with their failed rules)."""
    accepted = F.size("failed_rules") == 0
    return checked.where(accepted).drop("failed_rules"), checked.where(~accepted)


def with_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Typed request fields; a missing or unparsable value takes its default."""
    fields = {}
    for name, (kind, value) in (defaults or REQUEST_DEFAULTS).items():
        given = F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        fields[name] = F.coalesce(given, F.lit(value).cast(kind))
    return df.withColumns(fields)
