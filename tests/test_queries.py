"""Every registered query against its SQL oracle, over whole tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import DATA
from tests.oracle import compare, connect
from tillwork.plans import load

# The text queries have tests of their own.
QUERIES = {name: run for name, run in entry.queries().items() if name in load().QUERIES}
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    frame = QUERIES[name](spark, DATA)
    if name in ORACLES:
        assert compare(frame, duck, ORACLES[name]) is None
    else:
        assert frame.count() > 0


def test_every_query_of_the_catalogue_has_an_oracle():
    assert not set(QUERIES) - set(ORACLES)


def test_entry_gives_rows_with_a_stable_schema(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "c_custkey"
    assert frame.count() > 0
