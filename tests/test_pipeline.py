import json

import pytest
from pyspark.sql import functions as F

from estatelake import schemas
from estatelake.operators import cleaning
from estatelake.plans import medallion
from estatelake.sources import files, outputs
from estatelake.streaming import ingest as streaming_ingest
from estatelake.streaming import upsert as streaming_upsert


def listing(code, price, size, neighborhood="El Port", **more):
    return {
        "propertyCode": code, "propertyType": "flat", "price": price, "size": size, "rooms": 3, "bathrooms": 1,
        "municipality": "City", "neighborhood": neighborhood, "district": "Sud", "latitude": 41.0, "longitude": 2.0,
        "exterior": True, "status": "good", "distance": "300",
        "parkingSpace": {"hasParkingSpace": True}, "unknownField": 1,
    } | more


@pytest.fixture()
def drops(tmp_path):
    raw = tmp_path / "raw"
    for name in ("listings", "income", "density"):
        (raw / name).mkdir(parents=True)
    first = [listing(f"p{i}", 200000.0 + 1000 * i, 80.0) for i in range(20)]
    first += [listing("wild", 90000000.0, 80.0), listing("tiny", 200000.0, 9.0), listing("lost", 200000.0, 80.0, "Nowhere")]
    (raw / "listings" / "2020_05_01_market.json").write_text(json.dumps(first))
    second = [listing("p0", 205500.0, 80.0, hasLift=True), listing("away", 200000.0, 80.0, municipality="Town")]
    (raw / "listings" / "2021_02_03_market.json").write_text(json.dumps(second))
    (raw / "listings" / "2021_03_03_market.json").write_text("[]")
    (raw / "income" / "2020.csv").write_text(
        "Any,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Import_Euros\n"
        "2020,1,Sud,7,El Port,100.5\n2021,1,Sud,7,El Port,200.5\n2019,1,Sud,7,El Port,1\n2020,1,Sud,9,Elsewhere,7\n"
    )
    (raw / "density" / "2020.json").write_text(
        json.dumps([{"Any": "2020", "Nom_Barri": "El Port", "Densitat (hab/ha)": 55}], indent=2)
    )
    lookup = tmp_path / "lookup.csv"
    lookup.write_text(
        "district,neighborhood,district_n_reconciled,district_n,district_id,neighborhood_n_reconciled,neighborhood_n,neighborhood_id\n"
        "Sud,El Port,Sud,sud,D1,El Port,el port,Q1\n"
    )
    return tmp_path


def ingest_all(spark, base, **options):
    return {
        name: medallion.ingest(
            spark, name, f"{base}/raw/{name}/*", f"{base}/bronze/{name}", f"{base}/manifest/{name}", **options
        )
        for name in ("listings", "income", "density")
    }


def format_all(spark, base):
    lookup = files.read_lookup(spark, f"{base}/lookup.csv")
    medallion.run_silver(spark, f"{base}/bronze", f"{base}/silver", lookup, lookup)
    return {n: medallion.silver_table(spark, f"{base}/silver", n) for n in medallion.SILVER_KEYS}


def test_raw_to_gold(spark, drops):
    assert ingest_all(spark, drops) == {"listings": 3, "income": 1, "density": 1}
    assert ingest_all(spark, drops) == {"listings": 0, "income": 0, "density": 0}
    silver = format_all(spark, drops)
    assert silver["listings"].read().count() == 24
    assert sorted(tuple(r) for r in silver["income"].read().select("year", "income").collect()) == [(2020, 100.5), (2021, 200.5)]
    medallion.run_gold(spark, f"{drops}/silver", f"{drops}/gold", f"{drops}/gold_csv", "2024-01-31", "City")
    gold = files.read_gold(spark, f"{drops}/gold")
    assert {r[0] for r in gold.select("pipeline_execution_date").collect()} == {"2024-01-31"}
    written = spark.read.parquet(f"{drops}/gold")
    assert sorted(written.columns) == sorted(f.name for f in schemas.GOLD.fields)
    rows = gold.collect()
    assert len(rows) == 20
    newest = [r for r in rows if r["price"] == 205500.0]
    assert len(newest) == 1 and newest[0]["avg_income_index"] == 200.5
    assert newest[0]["density_val"] == 55.0 and newest[0]["hasLift"] is True
    assert {r["hasLift"] for r in rows} == {True, False}
    copy = files.read_dated_csv(spark, f"{drops}/gold_csv", gold.drop("pipeline_execution_date").schema)
    assert copy.count() == 20
    assert files.latest_partition(spark, f"{drops}/gold", "pipeline_execution_date").count() == 20


def test_reset_reads_everything_again(spark, drops):
    ingest_all(spark, drops)
    assert ingest_all(spark, drops, reset=True)["listings"] == 3
    assert spark.read.parquet(f"{drops}/bronze/listings").count() == 25


def test_lineage_and_year(spark, drops):
    ingest_all(spark, drops)
    rows = files.read_bronze(spark, f"{drops}/bronze/listings")
    years = {r["data_year"]: r["n"] for r in rows.groupBy("data_year").agg(F.count("*").alias("n")).collect()}
    assert years == {2020: 23, 2021: 2}
    row = rows.first()
    assert row["source_file"].endswith("_market.json") and row["ingestion_timestamp"] is not None
    assert files.read_bronze(spark, f"{drops}/bronze/listings", since="2999-01-01").count() == 0
    assert row["parkingSpace"]["hasParkingSpace"] is True


def test_corrupt_records_are_set_aside(spark, drops):
    (drops / "raw" / "listings" / "2022_01_01_market.json").write_text('{"propertyCode": "ok"}\n{"propertyCode": broken\n')
    ingest_all(spark, drops)
    bronze = files.read_bronze(spark, f"{drops}/bronze/listings")
    assert bronze.where("data_year = 2022").count() == 1
    rejected = files.read_rejected(spark, f"{drops}/bronze/listings")
    assert rejected.count() == 1 and "broken" in rejected.first()["_corrupt_record"]


def test_unreadable_parts_are_skipped(spark, tmp_path):
    path = f"{tmp_path}/t"
    outputs.write_partitioned(spark.range(10).selectExpr("id", "'2024-01-02' as day"), path, "day")
    (tmp_path / "t" / "day=2024-01-02" / "part-bad.parquet").write_bytes(b"PAR1 not parquet at all")
    spark.range(3).selectExpr("id", "'2024-01-01' as day").write.mode("append").partitionBy("day").parquet(path)
    assert sorted(r["id"] for r in files.latest_partition(spark, path, "day").collect()) == list(range(10))


def test_gold_write_modes(spark, tmp_path):
    path = f"{tmp_path}/gold"
    for day, n in (("2024-01-01", 3), ("2024-01-02", 5)):
        df = spark.range(n).withColumn("pipeline_execution_date", F.lit(day))
        outputs.write_gold(df, path, keep_other_dates=True)
    assert spark.read.parquet(path).count() == 8
    outputs.write_gold(spark.range(2).withColumn("pipeline_execution_date", F.lit("2024-01-03")), path)
    assert spark.read.parquet(path).count() == 2
    outputs.write_csv(spark.range(4), f"{tmp_path}/csv", one_file=True)
    assert spark.read.option("header", "true").csv(f"{tmp_path}/csv").count() == 4
    outputs.write_report(spark.range(1).withColumn("passed", F.lit(True)), f"{tmp_path}/report")
    assert spark.read.json(f"{tmp_path}/report").first()["passed"] is True


def test_stream_equals_batch(spark, drops):
    ingest_all(spark, drops)
    source, path, checkpoint = f"{drops}/raw/listings", f"{drops}/stream", f"{drops}/cp"

    def run():
        rows = streaming_ingest.bronze_stream(spark, "listings", source)
        streaming_ingest.ingest(rows, path, checkpoint).awaitTermination()
        return files.read_bronze(spark, path)

    columns = ["propertyCode", "price", "data_year"]
    batch = spark.read.parquet(f"{drops}/bronze/listings").select(*columns)
    assert run().select(*columns).exceptAll(batch).count() == 0 and run().count() == batch.count() == 25
    (drops / "raw" / "listings" / "2023_01_01_market.json").write_text(json.dumps([listing("new", 1.0, 2.0)]))
    assert run().count() == 26


def test_stream_upsert_follows_new_files(spark, drops, tmp_path):
    table = medallion.silver_table(spark, f"{tmp_path}/silver", "listings")

    def run():
        rows = streaming_ingest.bronze_stream(spark, "listings", f"{drops}/raw/listings").withColumnRenamed(
            "propertyCode", "property_id"
        ).select("property_id", "price", "source_file")
        newest = [F.desc("source_file"), F.desc("price")]
        streaming_upsert.upsert(rows, table, newest, f"{tmp_path}/cp").awaitTermination()
        return {r["property_id"]: r["price"] for r in table.read().collect()}

    first = run()
    assert len(first) == 24 and first["p0"] == 205500.0
    (drops / "raw" / "listings" / "2023_01_01_market.json").write_text(
        json.dumps([listing("p0", 5.0, 2.0), listing("brand-new", 6.0, 2.0)])
    )
    second = run()
    assert second == first | {"p0": 5.0, "brand-new": 6.0}


def test_cleaning_reads_only_the_silver_columns(spark, drops):
    ingest_all(spark, drops)
    bronze = files.read_bronze(spark, f"{drops}/bronze/listings")
    lookup = files.read_lookup(spark, f"{drops}/lookup.csv")
    cleaned = cleaning.clean_listings(bronze, lookup, medallion.newest_listing_first())
    plan = cleaned._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line and "propertyCode" in line]
    assert scans and not any("thumbnail" in line or "parkingSpace" in line for line in scans)


def test_requests_have_declared_types(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"size": 80, "rooms": 3, "neighborhood": "x", "ref": "a", "other": 1}\n')
    rows = files.read_requests(spark, str(tmp_path / "r.json"), extra="ref string")
    assert rows.columns == [f.name for f in schemas.VALUATION_REQUEST.fields] + ["ref"]
    row = rows.first()
    assert row["size"] == 80.0 and row["rooms"] == 3 and row["bathrooms"] is None and row["ref"] == "a"
