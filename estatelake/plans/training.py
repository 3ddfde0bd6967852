"""Training, selection and validation over a gold table."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.operators import imputing, models, sampling
from estatelake.operators.alphabetic import AlphabeticFeatures
from estatelake.operators.metrics import (
    GATES,
    METRIC_PLACES,
    gate_checks,
    gate_rules,
    gate_verdict,
    select_best,
)
from estatelake.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, RUN, TARGET
from estatelake.sources import outputs
from estatelake.staging import staged


def train_rows(gold: DataFrame) -> DataFrame:
    """Rows with all numeric features and the target."""
    return gold.dropna(subset=[*NUMERIC_FEATURES, TARGET])


def with_parts(gold: DataFrame, key: str) -> DataFrame:
    """Adds ``split`` (train or test) and ``fold`` by key hash."""
    return sampling.with_fold(sampling.with_split(gold, key), key)


def train_all(
    gold: DataFrame,
    key: str,
    specs: list[models.ModelSpec] | None = None,
    profile: str = "frequency",
    parallelism: int = 2,
    at_once: int = 3,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
) -> list[models.Trained]:
    """Fit every spec on the same staged feature vectors, to the whole train part.

    Up to ``at_once`` models are searched side by side, each with up to
    ``parallelism`` fits in flight; fewer of more rows (``ROWS_IN_FLIGHT``).
    """
    if profile == "frequency":
        rows = with_parts(train_rows(gold), key)
        features = models.fit_features(rows.where("split = 'train'"), numeric, categorical)
    else:
        filled = imputing.impute_unknown(gold.dropna(subset=[TARGET]), CATEGORICAL_FEATURES)
        rows = with_parts(filled, key)
        features = AlphabeticFeatures.fit(rows.where("split = 'train'"), numeric, categorical).pipeline()
    if specs is None:
        specs = models.FREQUENCY_SPECS if profile == "frequency" else models.ALPHABETIC_SPECS
    columns = [key, "split", "fold", TARGET, "features_raw"]
    with staged(features.transform(rows).select(*columns), "vectors", by="split") as vectors:
        train_part = vectors.where("split = 'train'")
        test_part = vectors.where("split = 'test'")
        shape = models.train_shape(train_part, features)

        def fit(spec: models.ModelSpec) -> models.Trained:
            return models.train(
                train_part, test_part, spec, features, shape, parallelism=parallelism
            )

        with ThreadPoolExecutor(shape.fits_at_once(at_once)) as pool:
            return list(pool.map(fit, specs))


def run_table(spark: SparkSession, trained: list[models.Trained]) -> DataFrame:
    """One row per fitted model, ready to append to the runs table."""
    rows = [{"run_id": uuid.uuid4().hex, **t.run} for t in trained]
    names = [f.name for f in RUN.fields if f.name != "finished_at"]
    schema = RUN.__class__([f for f in RUN.fields if f.name != "finished_at"])
    data = [tuple(row.get(name) for name in names) for row in rows]
    return spark.createDataFrame(data, schema).withColumn("finished_at", F.current_timestamp())


def search_table(spark: SparkSession, trained: list[models.Trained]) -> DataFrame:
    """One row per model, point of its grid and fold: params, error on the fold, rows fitted and held out."""
    rows = [
        (t.run["model"], {n: str(v) for n, v in tried.point.items()}, tried.fold, tried.rmse, tried.n_fitted, tried.n_held)
        for t in trained
        for tried in t.tried
    ]
    return spark.createDataFrame(rows, "model string, params map<string,string>, fold int, rmse double, n_fitted long, n_held long")


def winner(trained: list[models.Trained]) -> models.Trained:
    """Least rmse, the first on ties."""
    return min(trained, key=lambda t: t.run["rmse"])


def validate(
    spark: SparkSession,
    model: PipelineModel,
    gold: DataFrame,
    key: str,
    gates: list[tuple] = GATES,
    report: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(checks, verdicts) of a saved model on the test part of the split.

    Gaps take the medians of the train part.  The metrics are rounded as the rules
    have them; with a path given, the checks are written there as the report.
    """
    named = imputing.impute_unknown(gold, CATEGORICAL_FEATURES)
    parts = with_parts(named, key).where(F.col(TARGET).isNotNull())
    fitted = imputing.medians(parts.where("split = 'train'"), NUMERIC_FEATURES)
    filled = imputing.impute_median(parts.where("split = 'test'"), NUMERIC_FEATURES, fitted)
    record = models.evaluate(model.transform(filled), METRIC_PLACES)
    names = ["rmse", "r2", "mae", "mape", "residual_mean", "residual_std", "n_samples"]
    runs = spark.createDataFrame(
        [("validation", *[record[n] for n in names])],
        "model string, " + ", ".join(f"{n} double" for n in names[:-1]) + ", n_samples bigint",
    )
    rules = gate_rules(spark, gates)
    checks = gate_checks(runs, rules, ["model"])
    if report is not None:
        outputs.write_report(checks, report)
    return checks, gate_verdict(checks, rules, ["model"])


def best_of(runs: DataFrame) -> DataFrame:
    return select_best(runs, tie="run_id")
