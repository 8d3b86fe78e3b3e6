"""Every query with a SQL oracle agrees with DuckDB on the driver tables."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


def _names():
    from flurry.plans.registry import ORACLE
    return sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from flurry.plans.registry import ORACLE, QUERIES
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, msg


def test_every_query_has_a_callable(spark):
    import __spark_entry__ as ent
    qs, orc = ent.queries(), ent.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 60
