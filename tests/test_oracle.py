"""Every catalogue query equals its SQL oracle (DuckDB) on the small fixture."""

import os

import pytest

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver fixtures missing")


def _names():
    from cdc_lake.plans.catalog import QUERIES
    return sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    from tools.oracle_check import duck as make
    return make(SF_SMALL)


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    assert set(_names()) <= set(queries()) and set(_names()) <= set(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    from tools.oracle_check import canon

    df = queries()[name](spark, SF_SMALL)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    r = duck.execute(oracle_sql()[name])
    d_cols, d_rows = canon([c[0] for c in r.description], r.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert entry(spark).columns == ["p_name", "quantity"]
