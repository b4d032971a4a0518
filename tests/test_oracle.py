"""Every catalog query against its DuckDB SQL on the driver tables (sf0.001),
plus the driver contract itself."""

import pytest

import __spark_entry__ as E
from claimsdq.plans.queries import catalog
from conftest import SF_SMALL
from oracle_compare import compare, duck_conn

KEYS = sorted(catalog())


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 63
    missing = set(KEYS) - set(o)
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 30
    assert {"source_file", "data_quality_score", "total_records"} <= set(df.columns)


@pytest.fixture(scope="module")
def duck():
    return duck_conn(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    err = compare(srows, df.columns, res.fetchall(), dcols)
    assert err is None, err
