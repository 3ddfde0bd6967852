import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from estatelake.operators import outliers, quantiles


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("bound", [100_000, 50])
def test_matches_sorted_values(spark, bound):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(size=700), np.full(400, 1.25), -rng.random(300)])
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = quantiles.exact_quantiles(frame(spark, values), ["x"], wanted, bound)["x"]
    assert found == pytest.approx(list(np.quantile(values, wanted)), rel=1e-12)


def test_one_value_holding_most_rows(spark):
    values = [5.0] * 900 + list(range(100))
    found = quantiles.exact_quantiles(frame(spark, values), ["x"], [0.02, 0.5, 0.99], 10)["x"]
    assert found == pytest.approx(list(np.quantile(values, [0.02, 0.5, 0.99])))


def test_nulls_and_empty(spark):
    assert quantiles.exact_quantiles(frame(spark, [None]), ["x"], [0.5])["x"] == [None]
    found = quantiles.exact_quantiles(frame(spark, [None, 1, float("nan"), 3]), ["x"], [0.5])
    assert found["x"] == [2.0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-5, 40), min_size=45, max_size=120), st.floats(0, 1))
def test_bracketing_equals_direct(spark, values, p):
    found = quantiles.exact_quantiles(frame(spark, values), ["x"], [p], 8)["x"][0]
    assert found == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-9)


def test_fences_filter_and_audit(spark):
    rows = [(100.0 * s, float(s), 100.0) for s in range(20, 60)]
    rows += [(900000.0, 20.0, 45000.0), (5000.0, 10.0, 500.0), (None, 30.0, None)]
    df = spark.createDataFrame([(p * 10 if p else p, s, m) for p, s, m in rows], "price double, size double, price_m2 double")
    fences = outliers.iqr_fences(df.where(outliers.plausible()), "price_m2")
    audit = outliers.filter_audit(df, "price_m2", fences).first()
    assert audit["n_input"] == 43 and audit["n_outliers"] == 1
    assert audit["n_kept"] == df.where(outliers.plausible()).where(fences.holds("price_m2")).count()
    assert audit["n_input"] == audit["n_implausible"] + audit["n_outliers"] + audit["n_kept"]


def test_fences_of_nothing_keep_nothing(spark):
    empty = spark.createDataFrame([], "price_m2 double")
    assert outliers.iqr_filter(empty, "price_m2").count() == 0


def test_approximate_quantiles_within_rank_error(spark):
    values = list(range(10_000))
    low, high = quantiles.approx_quantiles(frame(spark, values), "x", [0.25, 0.75])
    assert abs(low - 2500) <= 100 and abs(high - 7500) <= 100
