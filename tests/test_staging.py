import pytest
from pyspark.sql import functions as F

from estatelake import staging
from estatelake.folders import folder_names
from estatelake.operators import enrichment


def test_stage_keeps_rows_and_schema(spark):
    df = spark.range(20).selectExpr("id", "id % 2 = 0 as even", "'x' as part")
    staged = staging.stage(df, "t")
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert staged.exceptAll(df).count() == 0 and staged.count() == 20
    by = staging.stage(df, "t", by="part")
    assert sorted(by.columns) == sorted(df.columns) and by.where("part = 'x'").count() == 20


def test_empty_frames_can_be_staged(spark):
    assert staging.stage(spark.createDataFrame([], "a int"), "empty").count() == 0


def test_staged_dimension_is_broadcast_without_a_hint(spark):
    small = staging.stage(spark.range(10).selectExpr("id as k", "id as v"), "dim")
    large = staging.stage(spark.range(1000).selectExpr("id % 10 as k"), "fact")
    plan = large.join(small, "k")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_cluster_without_shared_folder_is_refused(spark):
    class Context:
        master = "spark://host:7077"
        applicationId = "app-1"

    class Session:
        sparkContext = Context()
        conf = spark.conf

    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert staging.shared_dir(spark) == configured.rstrip("/")
    else:
        with pytest.raises(RuntimeError):
            staging.shared_dir(Session())


def test_limits(spark):
    assert staging.broadcast_limit(spark) == 10 * 1024 * 1024
    assert folder_names(spark, "/no/such/folder") == []


def test_hot_area_is_split_when_the_statistics_cannot_be_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = "cast(if(id % 3 = 0, 0, id % 500) as int)"
        listings = spark.range(0, 300_000, 1, 8).selectExpr(
            f"{hot} as neighborhood_id", "2020 as year", "uuid() as property_id"
        )
        income = spark.range(500).selectExpr("cast(id as int) as neighborhood_id", "2020 as year", "id * 1.0 as income")
        areas = staging.stage(enrichment.income_index(income), "areas")
        joined = enrichment.enrich(listings, areas).agg(F.count("year"), F.max("property_id"))
        assert joined.collect()[0][0] == 300_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
