"""Every registered query against its DuckDB counterpart on the smallest supplied tables."""

from pathlib import Path

import pytest

from tests.compare import difference, duck
from mostrador.checks.oracles import ORACLES
from mostrador.checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# At this size no day has enough orders for these rejects.
MAY_BE_EMPTY = {"weather_rejects", "fx_rejects"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="supplied tables not found")


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    problem = difference(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name])
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY)
