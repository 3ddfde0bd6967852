"""The alphabetic feature profile: code-point order indexes, population scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.numbers import to_double
from estatelake.operators.category_table import CategoryTable
from estatelake.operators.imputing import medians
from estatelake.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES


@dataclass(frozen=True)
class AlphabeticFeatures:
    """Fitted medians, means, deviations and the table of categories."""

    numeric: list[str]
    categorical: list[str]
    categories: CategoryTable
    median: dict[str, float]
    mean: dict[str, float]
    deviation: dict[str, float]

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        numeric: list[str] | None = None,
        categorical: list[str] | None = None,
    ) -> AlphabeticFeatures:
        numeric = numeric or NUMERIC_FEATURES
        categorical = categorical or CATEGORICAL_FEATURES
        median = medians(train, numeric)
        empty = [c for c, value in median.items() if value is None]
        if empty:
            raise ValueError(f"no values to fit in {empty}")
        filled = {c: F.coalesce(to_double(c), F.lit(median[c])) for c in numeric}
        stats = train.agg(
            *[F.avg(v).alias(f"{c}_mean") for c, v in filled.items()],
            *[F.stddev_pop(v).alias(f"{c}_std") for c, v in filled.items()],
        ).first()
        return cls(
            numeric,
            categorical,
            CategoryTable.fit(train, categorical),
            median,
            {c: stats[f"{c}_mean"] for c in numeric},
            {c: stats[f"{c}_std"] or 1.0 for c in numeric},
        )

    def pipeline(self) -> PipelineModel:
        """Category numbers, scaling and assembler as one savable model."""
        columns = ", ".join(self._scaled_sql())
        assembler = VectorAssembler(
            inputCols=[f"{c}_scaled" for c in self.numeric] + [f"{c}_encoded" for c in self.categorical],
            outputCol="features_raw",
            handleInvalid="skip",
        )
        derived = SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")
        return PipelineModel([self.categories, derived, assembler])

    def feature_names(self) -> list[str]:
        return self.numeric + [f"{c}_encoded" for c in self.categorical]

    def _scaled_sql(self) -> list[str]:
        return [
            f"(coalesce(try_cast(`{c}` AS double), {self.median[c]!r}D) - {self.mean[c]!r}D)"
            f" / {self.deviation[c]!r}D AS `{c}_scaled`"
            for c in self.numeric
        ]
