from datetime import datetime

import pytest

from workload.views import Tables

DAY = datetime(1998, 5, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = {
        "region": ([(1, "R")], "r_regionkey int, r_name string"),
        "nation": ([(3, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(5, 3, "M"), (6, None, "M")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "orders": ([(1, 5, DAY), (2, 6, DAY), (None, 5, DAY)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "part": ([(8, 7, "T"), (8, 7, "T")], "p_partkey long, p_size int, p_type string"),
        "lineitem": (
            [(o, n, 8, 4, 2.0, 9.0, 0.1, 0.2, "A", "O", DAY) for o, n in ((1, 1), (1, 2), (2, 1), (None, 1))],
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_line_items_are_dealt_out_by_part_and_by_order_only(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        listings = Tables(spark, folder).listings
        plan = listings._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(l_partkey" in plan and "hashpartitioning(l_orderkey" in plan
    # Customers meet orders alone: below that join there is no line item.
    below = plan[plan.index("hashpartitioning(o_custkey") :]
    assert "lineitem" not in below and "l_orderkey" not in below
    assert [r[0] for r in listings.select("property_id").orderBy("property_id").collect()] == ["1-1", "1-1", "1-2", "1-2"]
