"""Every registered query of this subpackage that has SQL against DuckDB, on the smallest supplied tables."""

from pathlib import Path

import pytest

from mostrador.llm.queries import ORACLES, QUERIES
from tests.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="supplied tables not found")


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) is None
