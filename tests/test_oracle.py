"""Every registered query against its SQL, on the small tables."""

import pytest

from labelloom.catalog.all import REGISTRY
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, con, name):
    outcome, _ = compare(spark, con, REGISTRY[name], SF)
    assert outcome.startswith(("ok", "rows-only")), outcome


def test_every_query_has_sql():
    assert [n for n, e in REGISTRY.items() if e.sql is None] == []
