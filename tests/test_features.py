import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from estatelake.operators import encoding, imputing, sampling
from estatelake.operators.alphabetic import AlphabeticFeatures
from estatelake.operators.category_table import CategoryTable
from estatelake.operators.fingerprint import fingerprint


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(4000).selectExpr("concat('id-', id) as id", "cast(id as double) as v")


def test_mean_ignores_nulls_and_all_null_stays(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    assert [tuple(r) for r in imputing.impute_mean(df, ["a", "b"]).collect()] == [
        (1.0, None),
        (2.5, None),
        (4.0, None),
    ]


def test_median_coerces_text_and_takes_fitted_values(spark):
    df = spark.createDataFrame([("1",), ("x",), ("5",), (None,), ("9",)], "a string")
    assert [r[0] for r in imputing.impute_median(df, ["a"]).collect()] == [1.0, 5.0, 5.0, 5.0, 9.0]
    assert imputing.impute_median(df, ["a"], {"a": 7.0}).collect()[1][0] == 7.0


def test_flag_and_unknown(spark):
    df = spark.createDataFrame([(None, None), (True, "x")], "f boolean, c string")
    filled = imputing.impute_unknown(imputing.impute_flag(df, ["f"]), ["c"])
    assert [tuple(r) for r in filled.collect()] == [(False, "Unknown"), (True, "x")]


def test_category_numbers_are_dense_and_ordered(spark):
    words = ["zeta", "Alpha", "élan", "beta", "Zulu", "Unknown", "beta", None, "a b"]
    df = spark.createDataFrame([(w,) for w in words], "c string")
    index = encoding.category_index(df, "c")
    found = [r["category"] for r in index.orderBy("idx").collect()]
    assert found == sorted({w for w in words if w} | {"Unknown"})
    assert sorted(r["idx"] for r in index.collect()) == list(range(len(found)))


def test_unseen_and_missing_share_the_unknown_index(spark):
    fit = spark.createDataFrame([("b",), ("a",)], "c string")
    index = encoding.category_index(fit, "c")
    rows = spark.createDataFrame([("a",), ("new",), (None,), ("b",)], "c string")
    encoded = {r["c"]: r["i"] for r in encoding.encode_with_index(rows, index, "c", "i").collect()}
    assert encoded == {"a": 1, "b": 2, "new": 0, None: 0}


def test_frequency_index_and_assembler(spark):
    df = spark.createDataFrame(
        [("x", 1.0), ("y", 2.0), ("y", None), ("z", 4.0)], "c string, n double"
    )
    model = encoding.frequency_index(df, ["c"])
    assert list(model.labelsArray[0]) == ["y", "x", "z"]
    new = spark.createDataFrame([("q", 1.0)], "c string, n double")
    assert model.transform(new).first()["c_idx"] == 3.0
    assert encoding.feature_assembler(["n"], ["c"]).transform(model.transform(df)).count() == 3


def test_a_million_categories_in_a_saved_model(spark, tmp_path):
    """Two rows of each category, so the table is as large as a third of the data and never on the driver."""
    rows = spark.range(2_000_000).selectExpr("concat('c', lpad(cast(id % 1000000 as string), 7, '0')) as c", "'x' as d", "id")
    model = PipelineModel([CategoryTable.fit(rows, ["c", "d"])])
    model.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    odd = spark.createDataFrame([("c0000007", "x", -1), ("new", None, -2), (None, "y", -3)], "c string, d string, id long")
    found = loaded.transform(rows.union(odd))
    # 'Unknown' comes before the categories, which begin with a small letter.
    wrong = found.where((F.col("id") >= 0) & (F.col("c_encoded") != F.col("id") % 1_000_000 + 1))
    assert wrong.isEmpty() and found.count() == 2_000_003
    assert [r[1:] for r in sorted(found.where("id < 0").select("id", "c_encoded", "d_encoded").collect(), reverse=True)] == [(8.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


@pytest.mark.parametrize("n", [1000, 1001, 30_000])
def test_rare_categories_share_slots(spark, n):
    rows = spark.range(n * 3).selectExpr(f"concat('c', case when id < 900 then 7 else id % {n} end) as c", "'x' as d")
    model = encoding.frequency_index(rows, ["c", "d"])
    found = model.transform(rows.union(spark.createDataFrame([("new", "new"), (None, None)], "c string, d string")))
    slots = {r["c"]: r["c_idx"] for r in found.select("c", "c_idx").distinct().collect()}
    assert slots["c7"] == 0.0 and max(slots.values()) <= encoding.SLOTS
    if n <= encoding.SLOTS:
        assert slots["new"] == slots[None] == len(set(slots.values())) - 1.0
    else:
        shared = encoding.SLOTS - encoding.HASHED_SLOTS
        assert sum(1 for s in slots.values() if s < shared) == shared and slots["new"] >= shared
    names = [found.schema[f"{c}_idx"].metadata["ml_attr"]["vals"] for c in "cd"]
    assert all(v is not None for vals in names for v in vals) and names[1] == ["x", "__unknown"]
    assert found.schema["c_idx"].metadata["ml_attr"]["type"] == "nominal" and found.count() == n * 3 + 2


@pytest.mark.parametrize("ddof", [0, 1])
def test_standardize(spark, ddof):
    values = np.array([1.0, 4.0, 4.0, 11.0])
    df = spark.createDataFrame([(float(v), 3.0) for v in values], "a double, k double")
    rows = encoding.standardize(df, ["a", "k"], ddof).collect()
    assert [r["a"] for r in rows] == pytest.approx(list((values - 5) / values.std(ddof=ddof)))
    assert {r["k"] for r in rows} == {0.0}


def test_alphabetic_pipeline(spark, tmp_path):
    rows = [("b", 1.0), ("a", None), ("c", 5.0), ("a", 3.0)]
    train = spark.createDataFrame(rows, "c string, n double")
    fitted = AlphabeticFeatures.fit(train, ["n"], ["c"])
    numbers = {r["category"]: r["idx"] for r in fitted.categories.table(spark).collect()}
    assert numbers == {"Unknown": 0, "a": 1, "b": 2, "c": 3} and fitted.median == {"n": 3.0}
    model = fitted.pipeline()
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = type(model).load(str(tmp_path / "m"))
    new = spark.createDataFrame([("c", 5.0), ("other", 3.0), (None, None)], "c string, n double")
    vectors = [list(r["features_raw"]) for r in loaded.transform(new).collect()]
    spread = float(np.std([1, 3, 5, 3]))
    assert vectors == [pytest.approx([2 / spread, 3.0]), pytest.approx([0.0, 0.0]), pytest.approx([0.0, 0.0])]


def test_split_is_stable_disjoint_and_near_its_share(keyed):
    first = {r["id"]: r["split"] for r in sampling.with_split(keyed, "id").collect()}
    again = {r["id"]: r["split"] for r in sampling.with_split(keyed.repartition(13), "id").collect()}
    assert first == again
    share = sum(v == "train" for v in first.values()) / len(first)
    assert 0.77 < share < 0.83
    shares = {r["split"]: r["percent"] for r in sampling.split_shares(sampling.with_split(keyed, "id")).collect()}
    assert shares["train"] == pytest.approx(share * 100)


def test_folds_and_samples(keyed):
    sizes = [r["count"] for r in sampling.with_fold(keyed, "id").groupBy("fold").count().collect()]
    assert len(sizes) == 3 and min(sizes) > 1200
    assert 0.46 < sampling.sample_fraction(keyed, "id", 50).count() / 4000 < 0.54
    some = sampling.sample_rows(keyed, "id", 100)
    assert some.count() == 100 and {r["id"] for r in some.collect()} == {
        r["id"] for r in sampling.sample_rows(keyed.repartition(7), "id", 100).collect()
    }
    assert sampling.sample_rows(keyed, "id", 10**6).count() == 4000


def test_fold_is_independent_of_split(keyed):
    marked = sampling.with_fold(sampling.with_split(keyed, "id"), "id")
    counts = marked.groupBy("split", "fold").count().collect()
    assert len(counts) == 6


def test_fingerprint(spark, keyed):
    base = fingerprint(keyed).first()
    assert base == fingerprint(keyed.repartition(11)).first()
    changed = keyed.withColumn("v", F.when(F.col("id") == "id-7", 0.5).otherwise(F.col("v")))
    assert fingerprint(changed).first()["content_sum"] != base["content_sum"]
