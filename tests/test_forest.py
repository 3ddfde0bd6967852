import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from estatelake.operators import binned, boosting, forest, models


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.range(3000).selectExpr(
        "concat('c', id % 7) as c", "cast(id * 31 % 13 as double) as x", "cast((id * 37) % 101 as double) / 3 as z",
        "cast((id * 37) % 101 as double) + (id % 7) * (id * 31 % 13) + id % 5 as price", "cast(id % 3 as int) as fold",
    )
    df = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    return VectorAssembler(inputCols=["i", "x", "z"], outputCol="features_raw").transform(df).repartition(4).cache()


def estimator(**more):
    return RandomForestRegressor(featuresCol="features_raw", labelCol="price", seed=42, **({"numTrees": 20, "maxDepth": 6, "maxBins": 120} | more))


def rmse(df, model):
    return model.transform(df).agg(F.sqrt(F.avg((F.col("prediction") - F.col("price")) ** 2))).first()[0]


def test_one_tree_of_undrawn_rows_is_that_of_spark(vectors, monkeypatch):
    """One tree takes all features; with every row once nothing is drawn."""
    real = forest._loading

    def undrawn(layout, plan):
        return lambda found: [(c, t, np.ones_like(d), np.zeros_like(p)) for c, t, d, p in real(layout, plan)(found)]

    monkeypatch.setattr(forest, "_loading", undrawn)
    own = models._grown_fit(vectors, estimator(numTrees=1), "fold")
    by_spark = estimator(numTrees=1, bootstrap=False).fit(vectors)
    assert isinstance(own, RandomForestRegressionModel) and own.totalNumNodes == by_spark.totalNumNodes
    found, wanted = (np.array([r[0] for r in m.transform(vectors).orderBy("price", "x").select("prediction").collect()]) for m in (own, by_spark))
    assert found == pytest.approx(wanted)
    assert own.featureImportances.toArray() == pytest.approx(by_spark.featureImportances.toArray())


def test_forest_is_as_good_as_that_of_spark(vectors, monkeypatch):
    """Over several blocks and tasks, with the tables of few trees at once."""
    monkeypatch.setattr(boosting, "TASK_ROWS", 500)
    monkeypatch.setattr(binned, "BLOCK_ROWS", 400)
    monkeypatch.setattr(forest, "TABLE_BYTES", 1 << 18)
    own, by_spark = models._grown_fit(vectors, estimator(), "fold"), estimator().fit(vectors)
    assert rmse(vectors, own) == pytest.approx(rmse(vectors, by_spark), rel=0.25)
    assert own.getNumTrees == 20 and max(t.depth for t in own.trees) == 6
    assert own.featureImportances.toArray() == pytest.approx(by_spark.featureImportances.toArray(), abs=0.15)
    again = models._grown_fit(vectors, estimator(), "fold")
    assert rmse(vectors, again) == pytest.approx(rmse(vectors, own))


def test_nodes_know_their_rows(spark, vectors):
    layout = binned.fit_layout(vectors, "features_raw", 3, 60)
    blocks = binned.binned(vectors, layout, "features_raw", "price", "fold").cache()
    trees = forest.grow(blocks, 3000, layout, forest.Forest(5, 4, 3, 0.0, 1, held=1), exact=True)
    assert len({t.count[0] for t in trees}) > 1 and all(1700 < t.count[0] < 2300 for t in trees)
    for t in trees:
        for k, f in enumerate(t.feature):
            assert t.count[k] >= 3 and t.squares[k] >= t.sum[k] ** 2 / t.count[k] * (1 - 1e-9)
            if f >= 0:
                for column in (t.count, t.sum, t.squares):
                    assert column[t.left[k]] + column[t.right[k]] == pytest.approx(column[k])


def test_grid_search_of_a_forest_grows_it_here(vectors, monkeypatch):
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda *a: pytest.fail("fitted by Spark"))
    spec = models.ModelSpec("RandomForest", models._forest, {"numTrees": [2, 4], "maxDepth": [2, 5]})
    tried = models._tree_search(vectors, spec, models.train_shape(vectors), "fold", 3, 4)
    assert len(tried) == 12 and all(t.n_fitted + t.n_held == 3000 for t in tried)
    assert models.best_point(tried)["maxDepth"] == 5


def test_deep_or_other_forests_stay_with_spark():
    assert forest.grows_here(estimator()) and forest.grows_here(estimator(maxDepth=forest.DEEPEST))
    assert not forest.grows_here(estimator(maxDepth=30)) and not forest.grows_here(estimator(subsamplingRate=0.5))
    assert not forest.grows_here(estimator(bootstrap=False))
