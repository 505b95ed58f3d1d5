"""Every query that has SQL against it, row by row, on the whole small tables."""

import pytest

from compare import connect, differences
from surveil.llm.oracles import ORACLES
from surveil.llm.queries import llm_queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert differences(llm_queries()[name](spark, FOLDER), duck, ORACLES[name]) == []


def test_all_are_registered():
    import __spark_entry__ as driver
    assert set(llm_queries()) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())
