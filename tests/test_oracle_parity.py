"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import pytest

from conftest import SF_SMALL
from wattlake.plans.registry import oracle_sql, queries

KEYS = sorted(oracle_sql())


def test_registry_shape():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


@pytest.mark.parametrize("key", KEYS)
def test_oracle(spark, duck, key):
    from check_oracle import compare
    sdf = queries()[key](spark, SF_SMALL).toPandas()
    ddf = duck.execute(oracle_sql()[key]).df()
    assert compare(sdf, ddf) is None, compare(sdf, ddf)
