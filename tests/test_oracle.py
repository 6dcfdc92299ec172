"""Every registered SQL-checked query equals its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_check import rows_of
from conftest import SF_SMALL

SQL = E.oracle_sql()


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL).toPandas()
    ddf = duck.execute(SQL[key]).df()
    c1, r1 = rows_of(sdf)
    c2, r2 = rows_of(ddf)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_query_has_a_check_kind():
    from assetqueue.plans.registry import REGISTRY
    E.queries()
    assert all(e.check in ("SQL", "ROWS", "PY") for e in REGISTRY.values())
    assert len(SQL) >= 70
