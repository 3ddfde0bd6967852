import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from estatelake.operators import binned, boosting, models
from estatelake.operators.tree_arrays import tree_arrays


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        c, x, z, w = int(rng.integers(0, 7)), float(rng.integers(0, 13)), float(rng.integers(0, 40)) / 3, float(rng.normal())
        rows.append((f"c{c}", x, z, w, float(3 * x * c + z * z + 20 * np.sin(w) + rng.normal()), i % 3))
    df = spark.createDataFrame(rows, "c string, x double, z double, w double, price double, fold int")
    stages = [StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep"), VectorAssembler(inputCols=["i", "x", "z", "w"], outputCol="features_raw")]
    return Pipeline(stages=stages).fit(df).transform(df).repartition(5).cache()


def gbt(**more):
    return GBTRegressor(featuresCol="features_raw", labelCol="price", seed=42, **({"maxIter": 8, "maxDepth": 3, "maxBins": 60} | more))


def outputs(df, model):
    return np.array([r[0] for r in model.transform(df).orderBy("price").select("prediction").collect()])


@pytest.mark.parametrize("more", [{}, {"maxDepth": 5, "stepSize": 0.3}, {"minInstancesPerNode": 40, "minInfoGain": 1.0}])
def test_boosted_trees_are_those_of_spark(vectors, more):
    """Also over several tasks, which is how the query ends over large tables."""
    by_spark = gbt(**more).fit(vectors)
    own = models._grown_fit(vectors, gbt(**more), "fold")
    assert isinstance(own, GBTRegressionModel) and own.treeWeights == by_spark.treeWeights
    assert outputs(vectors, own) == pytest.approx(outputs(vectors, by_spark), rel=1e-6)
    assert own.featureImportances.toArray() == pytest.approx(by_spark.featureImportances.toArray(), rel=1e-2)


def test_several_tasks_grow_the_trees_of_one(vectors, monkeypatch):
    one = models._grown_fit(vectors, gbt(), "fold")
    monkeypatch.setattr(boosting, "TASK_ROWS", 500)
    monkeypatch.setattr(binned, "BLOCK_ROWS", 256)
    several = models._grown_fit(vectors, gbt(), "fold")
    assert outputs(vectors, several) == pytest.approx(outputs(vectors, one))


def test_fits_of_folds_share_one_job(spark, vectors, monkeypatch):
    # Values that all folds have, as Spark takes the bins of a fit's own rows and this package those of all train rows.
    rounded = vectors.withColumn("r", F.round(F.greatest(F.lit(-2), F.least(F.lit(2), "w")), 1)).drop("features_raw")
    vectors = VectorAssembler(inputCols=["i", "x", "z", "r"], outputCol="features_raw").transform(rounded)
    ensembles = [(gbt(maxDepth=d, maxIter=n), fold) for d, n in ((2, 3), (4, 5)) for fold in range(3)]
    started = []
    repartition = type(vectors).repartition
    monkeypatch.setattr(type(vectors), "repartition", lambda self, *a: started.append(a) or repartition(self, *a))
    found = models._boosted_arrays(vectors, ensembles, "fold")
    assert len(started) == 1
    matrix = np.array([r[0].toArray() for r in vectors.orderBy("price").select("features_raw").collect()])
    for (estimator, fold), arrays in zip(ensembles, found):
        wanted = estimator.fit(vectors.where(F.col("fold") != fold))
        ((_, single),) = arrays.walk(matrix)
        assert single.T @ arrays.weights == pytest.approx(outputs(vectors, wanted), rel=1e-6)
        assert len(arrays.roots) == len(tree_arrays(spark, wanted).roots)


def test_small_messages_mean_more_jobs_and_the_same_trees(vectors, monkeypatch):
    ensembles = [(gbt(maxIter=3), fold) for fold in range(3)]
    together = models._boosted_arrays(vectors, ensembles, "fold")
    monkeypatch.setattr(boosting, "MESSAGE_BYTES", 1)
    for a, b in zip(together, models._boosted_arrays(vectors, ensembles, "fold")):
        assert a.prediction == pytest.approx(b.prediction)


def test_grid_search_of_a_boosted_model_uses_it(vectors, monkeypatch):
    monkeypatch.setattr(GBTRegressor, "_fit", lambda *a: pytest.fail("fitted alone"))
    spec = models.ModelSpec("GBTRegressor", models._boosted, {"maxIter": [2, 4], "maxDepth": [1, 2]})
    tried = models._tree_search(vectors, spec, models.train_shape(vectors), "fold", 3, 4)
    assert len(tried) == 12 and all(t.n_fitted + t.n_held == 3000 for t in tried)


def test_other_settings_stay_with_spark():
    assert boosting.grows_here(gbt())
    assert not boosting.grows_here(gbt(subsamplingRate=0.5))
    assert not boosting.grows_here(gbt(lossType="absolute"))


def test_thresholds_of_many_values_are_quantiles(spark, monkeypatch):
    df = spark.range(40000).selectExpr("cast(id * 7919 % 40000 as double) as x", "0.0 as price", "0 as fold")
    df = VectorAssembler(inputCols=["x"], outputCol="features_raw").transform(df)
    layout = binned.fit_layout(df, "features_raw", 1, 60)
    assert layout.bins == [60] and np.abs(np.diff([0, *layout.thresholds[0], 40000]) - 40000 / 60).max() < 80
    few = binned.fit_layout(df.where("x < 30"), "features_raw", 1, 60)
    assert list(few.thresholds[0]) == [k + 0.5 for k in range(29)]


def test_no_rows_beside_a_fold_is_an_error(vectors):
    with pytest.raises(Exception, match="no rows to fit"):
        models._boosted_arrays(vectors.where("fold = 0"), [(gbt(), 0)], "fold")
