import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from estatelake.operators import gram, models
from estatelake.operators.tree_arrays import nested_errors, tree_arrays, tree_outputs
from estatelake.plans import training
from workload import learning  # noqa: F401
from workload.registry import ORACLE


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(11)
    x = draw.normal(size=(400, 3)) * [1, 50, 0.2] + [0, 2000, 1]
    y = x @ [30, -2, 70] + draw.normal(size=400) * 40 + 1000
    return [(int(i) % 3, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]


@pytest.fixture(scope="module")
def table(spark, rows):
    gaps = [(0, None, 1.0, 1.0, 5.0), (1, 1.0, float("nan"), 1.0, 5.0), (2, 1.0, 1.0, 1.0, None)]
    return spark.createDataFrame(rows + gaps, "fold int, a double, b double, c double, y double").repartition(3)


def by_hand(rows, fold, penalties):
    given = np.array(rows)
    rest, held = given[given[:, 0] != fold], given[given[:, 0] == fold]
    x, y = rest[:, 1:4], rest[:, 4]
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.diag(penalties(x, y)), xc.T @ yc)
    b = y.mean() - x.mean(0) @ w
    return w, b, np.sqrt(np.mean((held[:, 4] - held[:, 1:4] @ w - b) ** 2))


@pytest.mark.parametrize("value", [0.0, 0.1, 10.0, 1e5])
def test_ridge_on_every_fold(rows, table, value):
    folds = gram.sums_by_fold(gram.gram_table(table, ["a", "b", "c"], "y", "fold"))
    for fit in gram.search(folds, {value: gram.ridge(value)}):
        w, b, rmse = by_hand(rows, fit.fold, lambda x, y: np.full(3, value))
        assert list(fit.coefficients) == pytest.approx(list(w), rel=1e-6)
        assert (fit.intercept, fit.rmse) == pytest.approx((b, rmse), rel=1e-6)
        assert fit.n_fitted + fit.n_held == 400


@pytest.mark.parametrize("value", [0.0, 0.1, 30.0])
def test_standardised_penalty_is_that_of_spark(rows, table, value):
    folds = gram.sums_by_fold(gram.gram_table(table, ["a", "b", "c"], "y", "fold"))
    fit = gram.search(folds, {value: gram.standardised(value)})[0]
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw", handleInvalid="skip").transform(table.where("fold <> 0 and y is not null"))
    scaler = StandardScaler(inputCol="raw", outputCol="x", withMean=True)
    linear = LinearRegression(featuresCol="x", labelCol="y", regParam=value, solver="normal")
    scaled, fitted = Pipeline(stages=[scaler, linear]).fit(vectors).stages
    assert list(fit.coefficients * scaled.std.toArray()) == pytest.approx(list(fitted.coefficients), rel=1e-6)


def test_tables_of_different_rows_add_up_and_dependent_columns_get_zero(table):
    wide = table.withColumns({"d": F.col("a") * 2, "e": F.lit(7.0)})
    names = ["a", "b", "c", "d", "e"]
    whole = gram.sums_by_fold(gram.gram_table(wide, names, "y", "fold"))
    parts = gram.merged(*[gram.gram_table(wide.where(c), names, "y", "fold") for c in ("a < 0", "a >= 0", "a is null")])
    for fold, sums in gram.sums_by_fold(parts).items():
        assert sums.matrix == pytest.approx(whole[fold].matrix)
    coefficients, _ = gram.total_of(whole).fit(np.zeros(5))
    assert coefficients[3] == coefficients[4] == 0


def test_a_linear_grid_of_the_plan_takes_all_rows(spark, rows):
    data = [(f"k{i}", *r[1:4], "u", "v", "w", 1.0, 2.0, r[4]) for i, r in enumerate(rows)]
    gold = spark.createDataFrame(
        data,
        "property_id string, size double, avg_income_index double, density_val double, neighborhood string, propertyType string, "
        "district string, rooms double, bathrooms double, price double",
    )
    spec = [s for s in models.FREQUENCY_SPECS if s.name == "LinearRegression"]
    (trained,) = training.train_all(gold, "property_id", spec)
    table = training.search_table(spark, [trained])
    assert table.count() == 6 and trained.n_fitted == training.with_parts(gold, "property_id").where("split = 'train'").count()
    assert all(r.n_fitted + r.n_held == trained.n_fitted for r in table.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.range(900).selectExpr(
        "concat('c', id % 7) as c", "cast(id % 13 as double) as x", "cast((id * 37) % 101 as double) / 3 as z",
        "cast((id * 37) % 101 as double) + (id % 7) * (id % 13) as y", "cast(id % 3 as int) as fold",
    )
    df = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    return VectorAssembler(inputCols=["i", "x", "z"], outputCol="features_raw").transform(df)


def outputs_by_node(model, matrix, cut):
    """Every tree's output for every row, asked node by node."""

    def ask(node, row):
        depth = 0
        while node.subtreeDepth() > 0 and (cut is None or depth < cut):
            split = node.split()
            value = float(row[split.featureIndex()])
            if hasattr(split, "leftCategories") and "Categorical" in split.getClass().getName():
                left = value in list(split.leftCategories())
            else:
                left = value <= split.threshold()
            node, depth = (node.leftChild() if left else node.rightChild()), depth + 1
        return node.prediction()

    return np.array([[ask(tree._call_java("rootNode"), row) for row in matrix] for tree in model.trees])


@pytest.mark.parametrize("cut", [0, 1, 3, None])
def test_walk_is_node_by_node(spark, vectors, cut):
    model = RandomForestRegressor(featuresCol="features_raw", labelCol="y", numTrees=4, maxDepth=5, seed=3).fit(vectors)
    matrix = np.array([r[0].toArray() for r in vectors.select("features_raw").limit(40).collect()])
    ((_, found),) = tree_arrays(spark, model).walk(matrix, [cut])
    assert found == pytest.approx(outputs_by_node(model, matrix, cut))


def test_shorter_forests_and_shallower_trees(vectors):
    model = RandomForestRegressor(featuresCol="features_raw", labelCol="y", numTrees=6, maxDepth=6, seed=3).fit(vectors)
    held = vectors.where("fold = 0")
    pairs = held.select("features_raw", "y").collect()
    matrix, y = np.array([r[0].toArray() for r in pairs]), np.array([r[1] for r in pairs])
    errors = nested_errors(held, model, "features_raw", 3, "y", [2, 6], [2, None])
    for (length, cut), (squares, n) in errors.items():
        outputs = outputs_by_node(model, matrix, cut)[:length]
        assert n == len(y) and squares == pytest.approx(np.mean((outputs.mean(axis=0) - y) ** 2))


def test_a_cut_tree_is_the_tree_of_that_depth(vectors):
    """One tree takes all features, so nothing but the depth differs."""
    deep, shallow = (
        RandomForestRegressor(featuresCol="features_raw", labelCol="y", numTrees=1, maxDepth=d, seed=5).fit(vectors) for d in (7, 3)
    )
    errors = [nested_errors(vectors, m, "features_raw", 3, "y", [1], [3]) for m in (deep, shallow)]
    assert errors[0][1, 3][0] == pytest.approx(errors[1][1, 3][0])


def test_boosting_in_stages_is_shorter_boosting(vectors):
    longer, shorter = (GBTRegressor(featuresCol="features_raw", labelCol="y", maxIter=n, maxDepth=2, seed=1).fit(vectors) for n in (6, 3))
    found = nested_errors(vectors, longer, "features_raw", 3, "y", [3, 6], [None])
    by_spark = shorter.transform(vectors).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
    assert found[3, None][0] == pytest.approx(by_spark)
    assert found[6, None][0] == pytest.approx(longer.evaluateEachIteration(vectors.withColumnRenamed("y", "label").withColumn("y", F.col("label")), "squared")[-1])


def test_tree_grids_give_every_point_and_fold(vectors):
    part = vectors.withColumnRenamed("y", "price")
    shape = models.train_shape(part)
    forest = models.ModelSpec("RandomForest", models._forest, {"numTrees": [2, 4], "maxDepth": [2, 5], "minInstancesPerNode": [1, 9]})
    boosted = models.ModelSpec("GBTRegressor", models._boosted, {"maxIter": [2, 4], "maxDepth": [1, 2]})
    for spec in (forest, boosted):
        tried = models._tree_search(part, spec, shape, "fold", 3, 4)
        assert [(t.point, t.fold) for t in tried] == [(p, f) for p in spec.points() for f in range(3)]
        assert all(t.n_fitted + t.n_held == 900 for t in tried)
    best = models.best_point(tried)
    assert best["maxIter"] == 4


def test_deep_forests_take_all_rows_like_the_other_models(vectors):
    part = vectors.withColumnRenamed("y", "price")
    assert ORACLE["train_alphabetic_forest"].replace("('RandomForest', 12)", "('Ridge', 4)") == ORACLE["train_alphabetic"]
    deep = [s for s in models.ALPHABETIC_SPECS if s.name == "RandomForest"][0].build(models.train_shape(part))
    known = models._forest(models.train_shape(part))
    trees = [e.setNumTrees(3).setMaxDepth(12).fit(part).toDebugString.partition("\n")[2] for e in (deep, known)]
    assert deep.getCacheNodeIds() and trees[0] == trees[1]


def test_large_fits_run_one_after_the_other():
    assert [models.TrainShape(n, 1.0, 60).fits_at_once(6) for n in (0, 1000, 2_500_000, 30_000_000)] == [6, 6, 2, 1]


def test_outputs_of_all_trees_for_each_row(spark, vectors):
    model = RandomForestRegressor(featuresCol="features_raw", labelCol="y", numTrees=4, maxDepth=5, seed=3).fit(vectors)
    found = vectors.select("features_raw", tree_outputs(spark, model, "features_raw", 3).alias("trees")).limit(50).collect()
    matrix = np.array([r["features_raw"].toArray() for r in found])
    assert np.array([r["trees"] for r in found]) == pytest.approx(outputs_by_node(model, matrix, None).T)
