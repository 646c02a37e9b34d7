"""Every registered query against its SQL on the smallest test tables."""

import pytest

from loanfold.bindings import REGISTRY
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.oracle])
def test_same_rows_as_sql(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_every_query_has_sql():
    assert [n for n, q in REGISTRY.items() if not q.oracle] == []
