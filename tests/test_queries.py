"""Every registered query against its SQL, row by row."""

import os

import pytest

import __spark_entry__ as driver
from catalog.oracles import all_oracles
from catalog.queries import all_queries
from compare import connect, differences

FOLDER = f"/root/testdata/sf{os.environ.get('SURVEIL_TEST_SF', '0.01')}"
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    frame = driver.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert differences(frame, duck, ORACLES[name]) == []


def test_registered_keys():
    assert set(all_queries()) <= set(driver.queries())
    without = set(all_queries()) - set(ORACLES)
    assert without == {"piecewise_forecast"}
    assert set(ORACLES) <= set(all_queries())


def test_entry_has_six_rows_per_window(spark):
    rows = driver.entry(spark)
    assert rows.count() > 0 and rows.groupBy("window_end").count().filter("count <> 6").isEmpty()
