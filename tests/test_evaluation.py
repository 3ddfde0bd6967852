import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelake.functions import valuation
from estatelake.operators import areas, metrics, requests


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(100, 30, 200)
    p = y + rng.normal(2, 10, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    e = y - p
    assert row["rmse"] == pytest.approx(np.sqrt((e**2).mean()), abs=0.005)
    assert row["r2"] == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(), abs=5e-5)
    assert row["mae"] == pytest.approx(np.abs(e).mean(), abs=0.005)
    assert row["mape"] == pytest.approx(np.abs(e / y).mean() * 100, abs=0.005)
    assert row["residual_mean"] == pytest.approx(e.mean(), abs=0.005)
    assert row["residual_std"] == pytest.approx(e.std(), abs=0.005)
    assert row["n_samples"] == 200


def test_zero_targets_do_not_break_mape(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["mape"] == 10.0 and row["n_samples"] == 2


def test_gates(spark):
    runs = spark.createDataFrame(
        [("good", 100000.0, 0.9, 50000.0), ("edge", 150000.0, 0.70, 100000.0), ("none", None, 0.9, 1.0)],
        "model string, rmse double, r2 double, mae double",
    )
    rules = metrics.gate_rules(spark)
    checks = metrics.gate_checks(runs, rules, ["model"])
    verdict = {(r["model"], r["rule_set"]): r["passed"] for r in metrics.gate_verdict(checks, rules, ["model"]).collect()}
    assert verdict[("good", "training")] and verdict[("good", "validation")]
    assert not verdict[("edge", "training")] and verdict[("edge", "validation")] and verdict[("edge", "versioning")]
    assert not any(passed for (model, _), passed in verdict.items() if model == "none")


def test_gate_of_a_metric_the_runs_lack_fails(spark):
    runs = spark.createDataFrame([("m", 1.0, 0.9)], "model string, rmse double, r2 double")
    rules = metrics.gate_rules(spark)
    checks = metrics.gate_checks(runs, rules, ["model"])
    verdict = {r["rule_set"]: r["passed"] for r in metrics.gate_verdict(checks, rules, ["model"]).collect()}
    assert not verdict["validation"] and verdict["training"]


def test_ranking(spark):
    runs = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 5.0), ("d", None)], "model string, rmse double")
    assert metrics.select_best(runs).first()["model"] == "a"
    board = metrics.leaderboard(runs).collect()
    assert [r["model"] for r in board] == ["a", "b", "c", "d"] and [r["is_winner"] for r in board][:2] == [True, False]
    assert metrics.best_run(runs, below=1.0).count() == 0
    assert metrics.best_run(runs, order=["model"]).first()["model"] == "a"


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_interval_is_linear_percentile(spark, p):
    values = [5.0, 1.0, 9.0, 2.0, 7.0, 7.5]
    df = spark.createDataFrame([(values,), ([3.0],)], "o array<double>")
    found = [r[0] for r in df.select(valuation.interval_of(F.col("o"), p)).collect()]
    assert found == pytest.approx([float(np.percentile(values, p * 100)), 3.0])


def test_floor_bands(spark):
    floors = [-1, 0, 1, 2, 3, 5, 6, 10, 11, None]
    df = spark.createDataFrame([(f,) for f in floors], "f int")
    assert [r[0] for r in df.select(valuation.floor_band(F.col("f"))).collect()] == [
        "low", "ground", "low", "low", "mid", "mid", "high", "high", "penthouse", None,
    ]


def test_card_and_error_band(spark):
    df = spark.createDataFrame([(100.0, 50.0), (0.0, 50.0), (100.0, 0.0)], "p double, s double")
    cards = df.select(*[c.alias(n) for n, c in valuation.card_columns(F.col("p"), F.col("s")).items()]).collect()
    assert tuple(cards[0]) == pytest.approx((90.0, 110.0, 2.0))
    assert tuple(cards[1]) == (None, None, None) and cards[2]["predicted_m2"] is None
    band = df.select(*[c.alias(n) for n, c in valuation.error_band(F.col("p"), F.lit(120.0)).items()]).first()
    assert tuple(band) == (0.0, 220.0)


REQUEST = "size double, rooms int, bathrooms int, neighborhood string, propertyType string, district string, avg_income_index double, density_val double"
GOOD = (80.0, 3, 1, "x", "flat", "d", 100.0, 5.0)


@pytest.mark.parametrize(
    "position,value,rule",
    [
        (0, 0.0, "size"), (0, 2000.5, "size"), (0, None, "size"), (1, -1, "rooms"), (1, 21, "rooms"),
        (2, 0, "bathrooms"), (2, 11, "bathrooms"), (3, "", "neighborhood"), (4, None, "propertyType"),
        (5, None, "district"), (6, 0.0, "avg_income_index"), (7, float("nan"), "density_val"),
    ],
)
def test_request_rules(spark, position, value, rule):
    row = list(GOOD)
    row[position] = value
    checked = requests.validate_rows(spark.createDataFrame([tuple(row), GOOD], REQUEST))
    assert [r["failed_rules"] for r in checked.collect()] == [[rule], []]
    accepted, rejected = requests.split_valid(checked)
    assert accepted.count() == 1 and rejected.count() == 1


def test_allowed_values_are_optional(spark):
    df = spark.createDataFrame([GOOD], REQUEST)
    rules = [requests.allowed_values("type", "propertyType", requests.PROPERTY_TYPES),
             requests.allowed_values("place", "district", requests.DISTRICTS)]
    assert requests.validate_rows(df, rules).first()["failed_rules"] == ["place"]


def test_defaults(spark):
    df = spark.createDataFrame([("x", "2", None)], "size string, rooms string, has_lift string")
    row = requests.with_defaults(df).first().asDict()
    assert row["size"] == 0.0 and row["rooms"] == 2 and row["has_lift"] is True
    assert row["propertyType"] == "flat" and row["density_val"] == 20000.0 and row["floor"] == 1


def test_fallback_chain(spark):
    measures = spark.createDataFrame(
        [("n1", 100.0, 10.0), ("n2", 200.0, None), ("n3", 0.0, 50.0)],
        "neighborhood_id string, income double, density_val double",
    )
    lookup = spark.createDataFrame(
        [("a", "n1", "D1"), ("b", "n2", "D1"), ("c", "n3", "D2")],
        "neighborhood string, neighborhood_id string, district string",
    )
    districts = areas.district_means(measures, lookup)
    asked = spark.createDataFrame(
        [(1, "n1", "D1"), (2, "n2", "D1"), (3, "n3", "D1"), (4, "n3", "D2"), (5, None, "D1"), (6, None, None)],
        "k int, neighborhood_id string, district string",
    )
    rows = {r["k"]: (r["avg_income_index"], r["density_val"], r["measure_source"]) for r in areas.with_area_measures(asked, measures, districts).collect()}
    assert rows == {
        1: (100.0, 10.0, "neighborhood"),
        2: (200.0, 10.0, "neighborhood"),
        3: (150.0, 10.0, "district"),
        4: (150.0, 10.0, "city"),
        5: (150.0, 10.0, "district"),
        6: (150.0, 10.0, "city"),
    }


def test_latest_and_merged_measures(spark):
    income = spark.createDataFrame([("n", 2020, 1.0), ("n", 2021, 2.0)], "id string, year int, income double")
    density = spark.createDataFrame([("m", 2020, 3.0)], "id string, year int, density_val double")
    merged = areas.merge_measures(
        areas.latest_measure(income, "id", "income"), areas.latest_measure(density, "id", "density_val"), "id"
    )
    assert sorted(tuple(r) for r in merged.collect()) == [("m", None, 3.0), ("n", 2.0, None)]


def test_importance_by_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 3.0, 4.0), (3.0, 4.0, 6.1)], "a double, b double, y double")
    top = metrics.top_importance(metrics.correlation_importance(df, ["a", "b"], "y"), 1).collect()
    assert [r["feature"] for r in top] == ["a"]
