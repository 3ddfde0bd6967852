import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from estatelake.operators import models
from estatelake.operators.metrics import top_importance
from estatelake.plans import training, valuation
from estatelake.streaming import scoring


@pytest.fixture(scope="module")
def gold(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        size = float(rng.uniform(30, 200))
        area = int(rng.integers(0, 6))
        rows.append(
            (
                f"p{i}", size, int(rng.integers(1, 6)), int(rng.integers(1, 4)), 100.0 + area, 20.0 * area + 1,
                f"area-{area}", ["flat", "chalet"][i % 2], f"district-{area % 3}",
                3000.0 * size + 20000 * area + float(rng.normal(0, 5000)),
            )
        )
    return spark.createDataFrame(
        rows,
        "property_id string, size double, rooms int, bathrooms int, avg_income_index double, density_val double, "
        "neighborhood string, propertyType string, district string, price double",
    )


def spec(name, **grid):
    known = {s.name: s for s in [*models.FREQUENCY_SPECS, *models.ALPHABETIC_SPECS]}[name]
    return models.ModelSpec(name, known.build, grid, known.scaled)


@pytest.fixture(scope="module")
def forest(gold):
    return training.train_all(gold, "property_id", [spec("RandomForest", numTrees=[6], maxDepth=[5])])[0]


def test_grid_search_picks_a_grid_value_and_fits_well(gold):
    linear, ridge = training.train_all(
        gold, "property_id", [spec("LinearRegression", regParam=[0.1, 0.01]), spec("Ridge", alpha=[1.0])]
    )
    assert linear.run["params"]["regParam"] in ("0.1", "0.01")
    assert ridge.run["params"]["alpha"] == "1"
    assert linear.run["r2"] > 0.95 and linear.run["n_samples"] > 80
    assert training.winner([linear, ridge]).run["rmse"] == min(linear.run["rmse"], ridge.run["rmse"])


def test_linear_matches_least_squares(spark, gold):
    marked = training.with_parts(gold, "property_id").where("split = 'train'")
    features = models.fit_features(marked)
    trained = training.train_all(gold, "property_id", [spec("LinearRegression", regParam=[0.0])])[0]
    rows = features.transform(marked).select("features_raw", "price").collect()
    x = np.array([r["features_raw"].toArray() for r in rows])
    y = np.array([r["price"] for r in rows])
    design = np.c_[np.ones(len(x)), x]
    wanted = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    scored = trained.model.transform(marked).select("prediction").collect()
    assert [r[0] for r in scored] == pytest.approx(list(wanted), rel=1e-6)


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) * [1, 5, 0.2]
    y = x @ [3, -2, 7] + rng.normal(size=200) * 4 + 100
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features_raw", "price"])
    shape = models.train_shape(df)
    fitted = models.ALPHABETIC_SPECS[0].build(shape).setRegParam(models.ridge_penalty(10.0, shape)).fit(df)
    xc, yc = x - x.mean(0), y - y.mean()
    wanted = np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc)
    assert list(fitted.coefficients) == pytest.approx(list(wanted), rel=1e-6)


def test_interval_is_percentile_of_trees(gold, forest):
    rows = gold.limit(40)
    scored = models.score(rows, forest.model, forest.run["rmse"]).collect()
    vectors = forest.model.transform(rows).select("property_id", "features_raw", "prediction").collect()
    by_id = {r["property_id"]: r for r in vectors}
    trees = forest.model.stages[-1].trees
    for r in scored:
        vector = by_id[r["property_id"]]["features_raw"]
        outputs = [t.predict(vector) for t in trees]
        assert r["predicted_price"] == pytest.approx(np.mean(outputs))
        assert r["confidence_low"] == pytest.approx(np.percentile(outputs, 10))
        assert r["confidence_high"] == pytest.approx(np.percentile(outputs, 90))


def test_other_models_take_the_error_band(gold):
    trained = training.train_all(gold, "property_id", [spec("GBTRegressor", maxIter=[3], maxDepth=[3])])[0]
    row = models.score(gold, trained.model, 10.0).first()
    assert row["confidence_high"] - row["predicted_price"] == pytest.approx(10.0)


def test_importance(spark, forest):
    names = forest.model.stages[1].getInputCols()
    table = models.importance_table(spark, forest.model.stages[-1], names)
    assert top_importance(table, 1).first()["feature"] == "size"
    assert models.importance_table(spark, forest.model.stages[-1], ["one"]).first()["feature"] == "Feat_0"


def test_run_table_and_best(spark, forest, tmp_path):
    runs = training.run_table(spark, [forest, forest])
    from estatelake.sources.outputs import append_runs

    append_runs(runs, str(tmp_path / "runs"))
    append_runs(runs.limit(1), str(tmp_path / "runs"))
    stored = spark.read.parquet(str(tmp_path / "runs"))
    assert stored.count() == 3 and stored.first()["params"]["numTrees"] == "6"
    assert training.best_of(stored).count() == 1


def test_validate_reads_the_test_part(spark, gold, forest):
    checks, verdict = training.validate(spark, forest.model, gold, "property_id")
    values = {r["metric"]: r["value"] for r in checks.where("rule_set = 'validation'").collect()}
    assert values["rmse"] == pytest.approx(forest.run["rmse"])
    assert {r["rule_set"] for r in verdict.collect()} == {"training", "registration", "validation", "versioning"}


def test_alphabetic_profile(gold):
    trained = training.train_all(gold, "property_id", [spec("Ridge", alpha=[1.0])], "alphabetic")[0]
    assert trained.run["r2"] > 0.9


def test_bulk_valuation(spark, gold, forest, tmp_path):
    path = str(tmp_path / "model")
    forest.model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    raw = gold.drop("price").withColumn("size", F.when(F.col("property_id") != "p3", F.col("size")).cast("string"))
    responses, rejected = valuation.value(raw, loaded, forest.run["rmse"], "v1")
    assert responses.count() == 599 and rejected.first()["failed_rules"] == ["size"]
    row = responses.first()
    assert row["confidence_low"] <= row["predicted_price"] <= row["confidence_high"]
    assert row["currency"] == "EUR" and row["floor_category"] == "low"
    assert row["card_low"] == pytest.approx(row["predicted_price"] * 0.9, rel=1e-6)


def test_valuation_takes_area_measures(spark, gold, forest):
    lookup = gold.select("neighborhood", F.col("neighborhood").alias("neighborhood_id"), "district").distinct()
    measures = spark.createDataFrame([("area-0", 100.0, 1.0)], "neighborhood_id string, income double, density_val double")
    from estatelake.operators.areas import district_means

    districts = district_means(measures, lookup)
    responses, rejected = valuation.value(
        gold.drop("price"), forest.model, 1.0, "v1", measures, districts, lookup
    )
    sources = {r[0] for r in responses.select("measure_source").distinct().collect()}
    assert sources == {"neighborhood", "district", "city"} and rejected.count() == 0


def test_stream_scores_like_batch(spark, gold, forest, tmp_path):
    gold.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(gold.schema).parquet(str(tmp_path / "in"))
    scoring.score_stream(
        stream, forest.model, forest.run["rmse"], str(tmp_path / "out"), str(tmp_path / "cp")
    ).awaitTermination()
    columns = ["property_id", "predicted_price", "confidence_low", "confidence_high"]
    found = scoring.read_output(spark, str(tmp_path / "out"), scoring.RESPONSES)
    streamed = sorted(tuple(r) for r in found.select(*columns).collect())
    batch = sorted(tuple(r) for r in models.score(gold, forest.model, forest.run["rmse"]).select(*columns).collect())
    assert streamed == batch


def with_gaps(gold):
    odd = F.col("property_id")
    return gold.withColumns(
        {
            "size": F.when(odd == "p1", float("nan")).when(odd != "p2", F.col("size")),
            "rooms": F.when(odd != "p2", F.col("rooms")),
            "propertyType": F.when(odd != "p3", F.col("propertyType")).otherwise("castle"),
            "district": F.when(odd != "p4", F.col("district")),
        }
    )


def test_every_request_is_scored_or_rejected(gold, forest):
    scored, rejected = models.score_or_reject(with_gaps(gold), forest.model, 1.0)
    reasons = {r["property_id"]: r["reasons"] for r in rejected.collect()}
    assert reasons == {"p1": ["size: not a number"], "p2": ["size: missing", "rooms: missing"]}
    ids = [r[0] for r in scored.select("property_id").collect()]
    assert len(ids) == 598 and {"p3", "p4"} <= set(ids) and not set(ids) & set(reasons)
    assert scored.columns == [*gold.columns, "predicted_price", "confidence_low", "confidence_high"]


def test_alphabetic_models_fill_gaps_before_they_reject(gold):
    trained = training.train_all(gold, "property_id", [spec("Ridge", alpha=[1.0])], "alphabetic")[0]
    scored, rejected = models.score_or_reject(with_gaps(gold), trained.model, 1.0)
    assert [(r["property_id"], r["reasons"]) for r in rejected.collect()] == [("p1", ["size: not a number"])]
    assert scored.count() == 599


def test_stream_writes_both_outputs_and_a_repeated_batch_counts_once(spark, gold, forest, tmp_path):
    rows = with_gaps(gold).drop("price")
    for n, part in enumerate([rows.where("rooms < 3 or rooms is null"), rows.where("rooms >= 3")]):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2 - n):
            stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
            scoring.score_stream(stream, forest.model, 1.0, str(tmp_path / "out"), str(tmp_path / f"cp{n}")).awaitTermination()
    # The second stream has a checkpoint of its own: its batch 0 holds all rows and replaces that of the first.
    outputs = [scoring.read_output(spark, str(tmp_path / "out"), name) for name in (scoring.RESPONSES, scoring.REJECTED)]
    assert [o.count() for o in outputs] == [598, 2]
    assert {tuple(r["reasons"]) for r in outputs[1].collect()} == {("size: not a number",), ("size: missing", "rooms: missing")}


def test_valuation_answers_every_request(gold, forest):
    accepted, rejected = valuation.value(with_gaps(gold).drop("price"), forest.model, 1.0, "v1")
    assert accepted.count() + rejected.count() == gold.count()
