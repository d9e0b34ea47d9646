"""Registered text queries against their SQL, where SQL can say them."""

import pytest

from catalog.compare import connect, difference
from isochron.llm.queries import oracles, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_names():
    assert oracles.keys() <= queries.keys()
    assert sorted(int(n[2:].split("_")[0]) for n in queries) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracles))
def test_query(spark, connection, name):
    found = difference(queries[name](spark, SF_DIR).toPandas(), connection.execute(oracles[name]).df())
    assert found is None, found
