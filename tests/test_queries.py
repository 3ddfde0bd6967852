import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract
from tests.check_queries import compare, duck

SF = "/root/testdata/sf0.001"
# Whole grids of deep forests and long boosting: minutes each, so only on demand.
SLOW = {"train_alphabetic_forest", "train_alphabetic_boosted"}
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, connection, name):
    if name in SLOW and not os.environ.get("RUN_SLOW"):
        pytest.skip("set RUN_SLOW to run")
    assert compare(spark, connection, name, SF) == ""


def test_entry(spark, connection):
    wanted = connection.execute(contract.oracle_sql()["gold_table"]).fetchall()
    assert contract.entry(spark).count() == len(wanted) > 0
