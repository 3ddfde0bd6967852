"""Regression models: specs, grid search, importance, intervals."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from estatelake.functions.numbers import not_negative
from estatelake.functions.valuation import error_band, percentile_of_sorted
from estatelake.operators import boosting, forest, gram
from estatelake.operators.binned import Layout, binned, fit_layout
from estatelake.operators.encoding import feature_assembler, frequency_index
from estatelake.operators.metrics import metric_columns, prediction_columns
from estatelake.operators.tree_arrays import TreeArrays, nested_errors, tree_outputs
from estatelake.operators.tree_models import arrays_of, boosted_model, forest_model, weights_of
from estatelake.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from estatelake.staging import staged

# Seed, least number of split bins, percentiles of the interval.
SEED = 42
MIN_BINS = 60
LOW_PERCENTILE = 0.10
HIGH_PERCENTILE = 0.90

# Spark's deepest tree; stands for "no limit".
DEEPEST = 30
# Sums of the nodes that a pass over the rows splits, for forests of such trees.
DEEP_MEMORY_MB = 512

# Rows that the fits in flight may have together: binned rows and residuals of so many stay in the executors' memory.
ROWS_IN_FLIGHT = 6_000_000


@dataclass(frozen=True)
class TrainShape:
    """What a spec may need to know about the train part."""

    rows: int
    target_std: float
    bins: int

    def fits_at_once(self, most: int) -> int:
        """Small fits run side by side; a large one has all cores and the memory for itself."""
        return max(1, min(most, ROWS_IN_FLIGHT // max(1, self.rows)))


@dataclass(frozen=True)
class ModelSpec:
    """A named estimator with its grid of parameter values."""

    name: str
    build: Callable[[TrainShape], object]
    grid: dict[str, list] = field(default_factory=dict)
    scaled: bool = False

    def points(self) -> list[dict]:
        """All combinations of the grid's values."""
        return [dict(zip(self.grid, values)) for values in product(*self.grid.values())]

    def param_map(self, estimator, point: dict, shape: TrainShape) -> dict:
        """A point of the grid as parameters of the estimator."""
        plain = {estimator.getParam(n): v for n, v in point.items() if n != "alpha"}
        return plain | ({estimator.regParam: ridge_penalty(point["alpha"], shape)} if "alpha" in point else {})


def ridge_penalty(alpha: float, shape: TrainShape) -> float:
    """The ``regParam`` that gives the ridge solution of penalty ``alpha``.

    Spark averages the squared error and measures the penalty in units of the
    target's deviation; ``alpha`` adds to the plain sum of squares.
    """
    return alpha * shape.target_std / shape.rows


def _linear(shape: TrainShape):
    return LinearRegression(featuresCol="features", labelCol=TARGET)


def _ridge(shape: TrainShape):
    return LinearRegression(
        featuresCol="features_raw",
        labelCol=TARGET,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )


def _forest(shape: TrainShape):
    return RandomForestRegressor(
        featuresCol="features_raw", labelCol=TARGET, seed=SEED, maxBins=shape.bins
    )


def _boosted(shape: TrainShape):
    return GBTRegressor(
        featuresCol="features_raw", labelCol=TARGET, seed=SEED, maxBins=shape.bins
    )


# Models and grids of the frequency-encoded profile.
FREQUENCY_SPECS = [
    ModelSpec("LinearRegression", _linear, {"regParam": [0.1, 0.01]}, scaled=True),
    ModelSpec("RandomForest", _forest, {"numTrees": [20, 50], "maxDepth": [5, 10]}),
    ModelSpec("GBTRegressor", _boosted, {"maxIter": [20, 50], "maxDepth": [3, 5]}),
]

def _deep_forest(shape: TrainShape):
    # Each row keeps its place in every tree, so that trees of very many nodes do not travel with every task.
    return _forest(shape).setCacheNodeIds(True).setMaxMemoryInMB(DEEP_MEMORY_MB)


# Models and grids of the alphabetic profile.
ALPHABETIC_SPECS = [
    ModelSpec("Ridge", _ridge, {"alpha": [0.01, 0.1, 1.0, 10.0]}),
    ModelSpec(
        "RandomForest",
        _deep_forest,
        {
            "numTrees": [50, 100],
            "maxDepth": [10, 20, DEEPEST],
            "minInstancesPerNode": [1, 2],
        },
    ),
    ModelSpec(
        "GradientBoosting",
        _boosted,
        {"maxIter": [50, 100], "maxDepth": [3, 5], "stepSize": [0.05, 0.1]},
    ),
]


@dataclass(frozen=True)
class Tried:
    """A point of a grid, fitted outside of a fold and judged on it."""

    point: dict
    fold: int
    rmse: float
    n_fitted: int
    n_held: int


@dataclass(frozen=True)
class Trained:
    """A fitted pipeline, its metrics on the test part, the rows it was fitted to and how its grid was judged."""

    model: PipelineModel
    run: dict
    n_fitted: int = 0
    tried: list[Tried] = field(default_factory=list)


def fit_features(train: DataFrame, numeric: list[str] | None = None, categorical: list[str] | None = None) -> PipelineModel:
    """Frequency indexers and assembler, fitted on the train part."""
    numeric = NUMERIC_FEATURES if numeric is None else numeric
    categorical = CATEGORICAL_FEATURES if categorical is None else categorical
    indexers = [frequency_index(train, categorical)] if categorical else []
    return PipelineModel([*indexers, feature_assembler(numeric, categorical)])


def train_shape(train: DataFrame, features: PipelineModel | None = None) -> TrainShape:
    """Rows and spread of the target, and bins enough for every category slot."""
    row = train.agg(F.count(TARGET).alias("n"), F.stddev_pop(TARGET).alias("s")).first()
    labels = [values for s in flat_stages(features) for values in getattr(s, "labelsArray", [])] if features is not None else []
    bins = max([MIN_BINS, *[len(values) + 1 for values in labels]])
    return TrainShape(row["n"], row["s"] or 0.0, bins)


def train(
    train_part: DataFrame,
    test_part: DataFrame,
    spec: ModelSpec,
    features: PipelineModel,
    shape: TrainShape | None = None,
    fold_column: str = "fold",
    folds: int = 3,
    parallelism: int = 2,
) -> Trained:
    """Grid search with folds, refit of the best, metrics on the test part; all fits take all rows.

    Both parts carry the feature vector already, so the indexers run once and
    not once per fold and grid point.  Linear grids are solved from the folds' sums; grids
    of trees are read off the largest ensemble of each fold (see ``gram`` and ``tree_arrays``); boosted
    ensembles grow side by side (see ``boosting``).
    """
    shape = shape or train_shape(train_part, features)
    estimator = spec.build(shape)
    tried: list[Tried] = []
    if len(spec.points()) > 1:
        if "regParam" in spec.grid or "alpha" in spec.grid:
            tried = _linear_search(train_part, spec, fold_column)
        else:
            tried = _tree_search(train_part, spec, shape, fold_column, folds, parallelism)
    chosen = best_point(tried) if tried else spec.points()[0]
    if boosting.grows_here(estimator) or forest.grows_here(estimator.copy(spec.param_map(estimator, chosen, shape))):
        best = PipelineModel([_grown_fit(train_part, estimator.copy(spec.param_map(estimator, chosen, shape)), fold_column)])
    else:
        best = Pipeline(stages=[*_scaling(spec), estimator]).fit(train_part, spec.param_map(estimator, chosen, shape))
    run = evaluate(best.transform(test_part))
    run |= {"model": spec.name, "params": {n: f"{v:.6g}" if n == "alpha" else str(v) for n, v in chosen.items()}}
    return Trained(PipelineModel([*features.stages, *best.stages]), run, shape.rows, tried)


def best_point(tried: list[Tried]) -> dict:
    """The point of least mean error over the folds, the first of equal ones."""
    errors: dict[tuple, list[float]] = {}
    for t in tried:
        errors.setdefault(tuple(t.point.items()), []).append(t.rmse)
    return dict(min(errors, key=lambda point: sum(errors[point]) / len(errors[point])))


def _linear_search(train_part: DataFrame, spec: ModelSpec, fold_column: str) -> list[Tried]:
    ((name, values),) = spec.grid.items()
    rows, names = gram.vector_fields(train_part.select(fold_column, TARGET, "features_raw"), "features_raw", vector_size(train_part))
    folds = gram.sums_by_fold(gram.gram_table(rows, names, TARGET, fold_column))
    penalty = gram.standardised if name == "regParam" else gram.ridge
    return [
        Tried({name: found.value}, found.fold, found.rmse, found.n_fitted, found.n_held)
        for found in gram.search(folds, {v: penalty(v) for v in values})
    ]


def _tree_search(
    train_part: DataFrame, spec: ModelSpec, shape: TrainShape, fold_column: str, folds: int, parallelism: int
) -> list[Tried]:
    """One ensemble for each fold and each value that is not nested, the largest of those that are."""
    length = "numTrees" if "numTrees" in spec.grid else "maxIter"
    nested = {length} | ({"maxDepth"} if length == "numTrees" else set())
    outer = [dict(zip(names, values)) for names in [[n for n in spec.grid if n not in nested]] for values in product(*[spec.grid[n] for n in names])]
    largest = {n: max(values) for n, values in spec.grid.items() if n in nested}
    lengths = spec.grid.get(length, [None])
    cuts = spec.grid.get("maxDepth", [None]) if "maxDepth" in nested else [None]
    size = vector_size(train_part)
    estimator = spec.build(shape)
    jobs = [(point, fold) for point in outer for fold in range(folds)]
    ensembles = [(estimator.copy(spec.param_map(estimator, largest | point, shape)), fold) for point, fold in jobs]
    grown = {}
    if all(boosting.grows_here(e) or forest.grows_here(e) for e, _ in ensembles):
        grow = _boosted_arrays if isinstance(estimator, GBTRegressor) else _forest_arrays
        grown = dict(zip(range(len(jobs)), grow(train_part, ensembles, fold_column)))

    def fit(job: int) -> list[Tried]:
        point, fold = jobs[job]
        rest, held = train_part.where(F.col(fold_column) != fold), train_part.where(F.col(fold_column) == fold)
        model = grown.get(job) or spec.build(shape).fit(rest, spec.param_map(estimator, largest | point, shape))
        errors = nested_errors(held, model, "features_raw", size, TARGET, lengths, cuts)
        found = []
        for (trees, depth), (squares, n) in errors.items():
            own = point | {length: trees} | ({"maxDepth": depth} if "maxDepth" in nested and "maxDepth" in spec.grid else {})
            found.append(Tried({name: own[name] for name in spec.grid}, fold, math.sqrt(squares), shape.rows - n, n))
        return found

    with ThreadPoolExecutor(shape.fits_at_once(parallelism)) as pool:
        tried = [t for found in pool.map(fit, range(len(jobs))) for t in found]
    order = {tuple(p.items()): k for k, p in enumerate(spec.points())}
    return sorted(tried, key=lambda t: (order[tuple(t.point.items())], t.fold))


@contextmanager
def _bins(rows: DataFrame, estimator: GBTRegressor | RandomForestRegressor, fold_column: str) -> Iterator[tuple[Layout, DataFrame, int]]:
    """The bins of all rows, the rows as staged blocks of bins, and their number."""
    vector = estimator.getFeaturesCol()
    layout = fit_layout(rows, vector, vector_size(rows, vector), estimator.getMaxBins())
    with staged(binned(rows, layout, vector, estimator.getLabelCol(), fold_column), "bins") as blocks:
        yield layout, blocks, blocks.agg(F.sum("n")).first()[0] or 0


def _boosted_arrays(rows: DataFrame, ensembles: list[tuple[GBTRegressor, int]], fold_column: str) -> list[TreeArrays]:
    """An ensemble for each (estimator, fold): fitted to all rows but those of the fold."""
    with _bins(rows, ensembles[0][0], fold_column) as (layout, blocks, n):
        grown = boosting.boost(blocks, n, layout, [boosting.Boosting.of(e, fold) for e, fold in ensembles])
    return [arrays_of(trees, layout, weights_of(len(trees), e.getStepSize())) for (e, _), trees in zip(ensembles, grown)]


def _forest_arrays(rows: DataFrame, ensembles: list[tuple[RandomForestRegressor, int]], fold_column: str) -> list[TreeArrays]:
    """A forest for each (estimator, fold), one after the other: each has all executors for itself."""
    with _bins(rows, ensembles[0][0], fold_column) as (layout, blocks, n):
        grown = [forest.grow(blocks, n, layout, forest.Forest.of(e, fold)) for e, fold in ensembles]
    return [arrays_of(trees, layout, [1.0] * len(trees), averaged=True) for trees in grown]


def _grown_fit(
    rows: DataFrame, estimator: GBTRegressor | RandomForestRegressor, fold_column: str
) -> GBTRegressionModel | RandomForestRegressionModel:
    """Spark's model of the trees that this package grows."""
    with _bins(rows, estimator, fold_column) as (layout, blocks, n):
        if isinstance(estimator, RandomForestRegressor):
            return forest_model(rows.sparkSession, estimator, forest.grow(blocks, n, layout, forest.Forest.of(estimator), exact=True), layout)
        (trees,) = boosting.boost(blocks, n, layout, [boosting.Boosting.of(estimator)], exact=True)
        return boosted_model(rows.sparkSession, estimator, trees, layout)


def vector_size(rows: DataFrame, column: str = "features_raw") -> int:
    """Elements of a vector column, as its metadata has it, else as its first row has it."""
    known = rows.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    return known or len(rows.select(column).first()[0])


def evaluate(scored: DataFrame, places: dict[str, int] | None = None) -> dict:
    """Metrics and prediction range of a scored table as one record, in one pass.

    In full precision, unless ``places`` says how to round.
    """
    known = scored.where(F.col(TARGET).isNotNull())
    columns = [*metric_columns(TARGET, "prediction", places or {}), *prediction_columns("prediction")]
    return known.agg(*columns).first().asDict()


def importance_table(spark, model: Model, names: list[str]) -> DataFrame:
    """Tree importances or absolute coefficients by feature name."""
    if hasattr(model, "featureImportances"):
        scores = [float(v) for v in model.featureImportances.toArray()]
    else:
        scores = [abs(float(v)) for v in model.coefficients.toArray()]
    if len(names) != len(scores):
        names = [f"Feat_{i}" for i in range(len(scores))]
    rows = [Row(feature=n, importance=s) for n, s in zip(names, scores)]
    return spark.createDataFrame(rows, "feature string, importance double")


def score_or_reject(requests: DataFrame, model: PipelineModel, rmse: float) -> tuple[DataFrame, DataFrame]:
    """(responses, rejected requests with their ``reasons``); every request is in one of them.

    A request is rejected if an input of the model is null or NaN after the stages that fill and
    index; categories the model never saw have a slot of their own and are scored.
    """
    judged = with_reject_reasons(requests, model)
    whole = F.size("reasons") == 0
    return score(judged.where(whole).drop("reasons"), model, rmse), judged.where(~whole)


def with_reject_reasons(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``reasons``: the inputs of the model that a request lacks, in the model's order."""
    stages = flat_stages(model)
    at = next((k for k, s in enumerate(stages) if isinstance(s, VectorAssembler)), None)
    if at is None:
        return requests.withColumn("reasons", F.array().cast("array<string>"))
    inputs = PipelineModel(stages[:at]).transform(requests)
    reasons = []
    for name in stages[at].getInputCols():
        value = F.col(name).cast("double")
        shown = name.removesuffix("_scaled").removesuffix("_encoded").removesuffix("_idx")
        reasons.append(F.when(value.isNull(), f"{shown}: missing").when(F.isnan(value), f"{shown}: not a number"))
    return inputs.select(*requests.columns, F.array_compact(F.array(*reasons)).alias("reasons"))


def flat_stages(model: PipelineModel) -> list:
    """The stages of a pipeline and of the pipelines in it."""
    return [s for stage in model.stages for s in (flat_stages(stage) if isinstance(stage, PipelineModel) else [stage])]


def score(requests: DataFrame, model: PipelineModel, rmse: float) -> DataFrame:
    """Predicted price with an interval, never below zero, of requests that lack no input.

    Forests give the spread of their trees; other models one RMSE either side.
    """
    *before, last = model.stages
    if isinstance(last, RandomForestRegressionModel):
        scored = with_tree_outputs(PipelineModel(before).transform(requests), last, "_trees")
        trees = F.col("_trees")
        ordered = F.sort_array(trees)
        prediction = F.aggregate(trees, F.lit(0.0), lambda total, x: total + x) / F.size(trees)
        low = not_negative(percentile_of_sorted(ordered, LOW_PERCENTILE))
        high = not_negative(percentile_of_sorted(ordered, HIGH_PERCENTILE))
    else:
        scored = model.transform(requests)
        prediction = F.col("prediction")
        band = error_band(prediction, F.lit(float(rmse)))
        low, high = band["confidence_low"], band["confidence_high"]
    return scored.select(
        *requests.columns,
        not_negative(prediction).alias("predicted_price"),
        low.alias("confidence_low"),
        high.alias("confidence_high"),
    )


def with_tree_outputs(df: DataFrame, forest: RandomForestRegressionModel, output: str) -> DataFrame:
    """Adds the array of the single trees' predictions; one function walks all trees (see ``tree_arrays``)."""
    vector = forest.getFeaturesCol()
    return df.withColumn(output, tree_outputs(df.sparkSession, forest, vector, forest.numFeatures))


def _scaling(spec: ModelSpec) -> list:
    if not spec.scaled:
        return []
    return [
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True)
    ]


def rounded_prices(places: int = 2) -> dict[str, Column]:
    """Response columns with money rounded half to even."""
    return {
        name: F.bround(F.col(name), places)
        for name in ("predicted_price", "confidence_low", "confidence_high")
    }
