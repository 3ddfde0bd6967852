import datetime
import math

import pytest
from pyspark.sql import functions as F

from estatelake.functions import names
from estatelake.functions.hashing import row_text
from estatelake.functions.numbers import mean_of, ratio
from estatelake.operators import cleaning
from estatelake.operators.fingerprint import fingerprint
from estatelake.sources import files

LOOKUP = "neighborhood string, neighborhood_id string, district string"


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [("El Port", "Q1", "Sud"), ("La Font", "Q2", "Nord"), ("Dalt", "Q3", "Nord")]
    return spark.createDataFrame(rows, LOOKUP)


def listing(**changes):
    row = {
        "propertyCode": "a",
        "propertyType": "flat",
        "price": "100000",
        "size": "50",
        "rooms": "2",
        "bathrooms": "1",
        "municipality": "City",
        "neighborhood": "El Port",
        "district": "Sud",
        "latitude": "41.5",
        "longitude": "2.1",
        "hasLift": "true",
        "exterior": "false",
        "status": "good",
        "distance": "450",
        "data_year": "2020",
        "seq": 1,
    }
    return row | changes


def test_newest_copy_wins_and_bad_values_become_null(spark, lookup):
    raw = spark.createDataFrame(
        [
            listing(),
            listing(price="120000", data_year="2021", distance="far", seq=2),
            listing(propertyCode="b", neighborhood="Nowhere", size="0", hasLift=None),
        ]
    )
    rows = cleaning.clean_listings(raw, lookup, [F.desc("seq")])
    assert rows.columns == cleaning.SILVER_LISTING
    found = {r["property_id"]: r for r in rows.collect()}
    assert found["a"]["price"] == 120000.0 and found["a"]["data_year"] == 2021
    assert found["a"]["distance"] is None and found["a"]["neighborhood_id"] == "Q1"
    assert found["b"]["neighborhood_id"] is None and found["b"]["hasLift"] is None


def test_rank_filter_reduces_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = cleaning.latest_per_key(df, ["k"], [F.desc("v")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_keeps_one_row(spark):
    df = spark.range(50_000).selectExpr("if(id % 3 = 0, id, -1) as k", "id as v")
    kept = cleaning.latest_per_key(df, ["k"], [F.desc("v")])
    assert kept.count() == df.select("k").distinct().count()
    assert kept.where("k = -1").first()["v"] == 49_999


def income_row(year, barri, amount):
    return (year, "1", "Sud", "7", barri, amount)


INCOME = "Any string, Codi_Districte string, Nom_Districte string, Codi_Barri string, Nom_Barri string, Import_Euros string"


def test_income_mean_by_area_and_year(spark, lookup):
    raw = spark.createDataFrame(
        [
            income_row("2020", "El Port", "10.5"),
            income_row("2020", "El Port", "11.5"),
            income_row("2020", "El Port", "n/a"),
            income_row("2019", "El Port", "99"),
            income_row("2020", "Unknown place", "5"),
            income_row("2020", "La Font", "n/a"),
        ],
        INCOME,
    )
    years = spark.createDataFrame([(2020,), (2021,)], "year int")
    found = {r["neighborhood_id"]: r for r in cleaning.clean_income(raw, lookup, years).collect()}
    assert set(found) == {"Q1", "Q2"}
    assert found["Q1"]["income"] == 11.0 and found["Q1"]["year"] == 2020
    assert found["Q2"]["income"] is None


def test_density_mean(spark, lookup):
    raw = spark.createDataFrame(
        [("2020", "Dalt", "10"), ("2020", "Dalt", "20"), ("2022", "Dalt", "30")],
        "Any string, Nom_Barri string, `Densitat (hab/ha)` string",
    )
    years = spark.createDataFrame([(2020,)], "year int")
    assert [tuple(r) for r in cleaning.clean_density(raw, lookup, years).collect()] == [("Q3", 2020, 15.0)]


def test_misses_and_duplicates(spark, lookup):
    df = spark.createDataFrame([("x", "El Port"), ("x", "Z"), ("y", "Z")], "id string, neighborhood string")
    assert [tuple(r) for r in cleaning.lookup_misses(df, lookup).collect()] == [("Z", 2)]
    assert [tuple(r) for r in cleaning.duplicate_keys(df, ["id"]).collect()] == [("x", 2)]


def test_null_keys_are_split_off(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    whole, rejected = cleaning.split_null_keys(df, ["a", "b"])
    assert whole.count() == 1 and rejected.count() == 2


def test_dates_become_midnight(spark):
    df = spark.createDataFrame([(datetime.date(2020, 5, 1), "x")], "d date, s string")
    out = cleaning.date_columns_to_timestamps(df)
    assert out.first()["d"] == datetime.datetime(2020, 5, 1) and out.schema["s"].dataType.typeName() == "string"


def test_file_year(spark):
    paths = ["file:/x/2020_01_24_market.json", "file:/x/notes.txt", "/2021_1_1_market.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    years = [r[0] for r in df.select(names.file_year(names.file_name(F.col("p")), "market")).collect()]
    assert years == [2020, None, None]


def test_safe_names(spark):
    assert names.safe_name("Densitat (hab/ha)") == "Densitat_hab/ha"
    assert names.safe_name("a=b.c") == "abc"
    df = spark.createDataFrame([(1, 2)], ["a b", "a_b"])
    with pytest.raises(ValueError, match="collide"):
        names.sanitize_columns(df)


def test_ratio_and_mean(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, 1.5, None]
    assert df.agg(mean_of("a")).first()[0] == 2.0
    assert df.where("false").agg(mean_of("a")).first()[0] is None
    value = 128471.27333333333
    one = spark.createDataFrame([(value,)], "a double")
    assert one.agg(mean_of("a")).first()[0] == value


@pytest.mark.parametrize(
    "values, mean",
    [([1.0, 1e24, 3.0], 1e24 / 3), ([6e22, 6e22], 6e22), ([1e-17, 3e-17], 2e-17), ([1e-8, None], 1e-8)],
)
def test_means_of_any_size(spark, values, mean):
    df = spark.createDataFrame([(1, 2020, v) for v in values], "neighborhood_id int, year int, v double")
    assert df.agg(mean_of("v")).first()[0] == pytest.approx(mean, rel=1e-12)
    by_area = cleaning.mean_by_area_year(df, "v", []).first()["v"]
    assert by_area == pytest.approx(mean, rel=1e-12)


def test_nan_shows_in_a_mean(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "v double")
    assert math.isnan(df.agg(mean_of("v")).first()[0])


def test_rows_without_a_key_are_all_kept(spark):
    rows = [(None, i) for i in range(10)] + [("a", 1), ("a", 2)]
    df = spark.createDataFrame(rows, "id string, v int")
    found = cleaning.latest_per_key(df, ["id"], [F.desc("v")]).collect()
    assert sorted((r["id"] or "", r["v"]) for r in found) == [("", i) for i in range(10)] + [("a", 2)]


def test_a_name_listed_twice_repeats_no_row(spark):
    lookup = spark.createDataFrame([("x", "2"), ("x", "1"), ("y", "3")], "neighborhood string, neighborhood_id string")
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "neighborhood string")
    found = {tuple(r) for r in cleaning.with_area_id(df, lookup).collect()}
    assert found == {("x", "1"), ("y", "3"), ("z", None)} and cleaning.with_area_id(df, lookup).count() == 3
    assert [tuple(r) for r in cleaning.duplicate_keys(lookup, ["neighborhood"]).collect()] == [("x", 2)]


def test_different_rows_have_different_texts(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("~", "x"), ("1:a", ""), ("", None), ("", "~")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(row_text([F.col("a"), F.col("b")])).distinct().count() == len(rows)
    first, second = (fingerprint(df.limit(n)).first() for n in (1, 2))
    assert first != second


def test_csv_columns_are_found_by_header(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("Any,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Import_Euros\n2020,1,Sud,7,Port,1.5\n")
    (tmp_path / "sub" / "b.csv").write_text(
        "Nom_Barri,extra,Import_Euros,Any,Codi_Barri,Nom_Districte,Codi_Districte\n\"Gracia, alta\",e,2.5,2021,8,Nord,\n"
    )
    (tmp_path / "c.csv").write_text('some,other,file\n1,,"3, and more",\n\n')
    found = files.with_lineage(files.read_raw(spark, "income", str(tmp_path)))
    rows = {(r["Any"], r["Nom_Barri"], r["Import_Euros"], r["Codi_Districte"]) for r in found.where("_corrupt_record is null").collect()}
    assert rows == {("2020", "Port", "1.5", "1"), ("2021", "Gracia, alta", "2.5", None)}
    assert sorted(r["_corrupt_record"] for r in found.where("_corrupt_record is not null").collect()) == ['1,,"3, and more",', "some,other,file"]
    assert "_metadata" not in found.columns


def test_folder_without_a_date_is_no_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-02"), (2, "2024-01-10"), (3, None)], "v int, day string")
    df.write.partitionBy("day").parquet(str(tmp_path / "t"))
    assert [r["v"] for r in files.latest_partition(spark, str(tmp_path / "t"), "day").collect()] == [2]
