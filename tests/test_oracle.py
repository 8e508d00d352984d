"""Every registered query against its DuckDB oracle on the smallest driver data."""

import os

import pytest

import __spark_entry__ as entry
from fleetdw.checks.oracle_queries import oracle_sql
from fleetdw.queries import registry
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


QUERIES = registry()
ORACLE = oracle_sql(SF) if os.path.isdir(SF) else {}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, _, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert ok, detail
    assert n > 0, "query returned no rows on the driver data"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["patio_origem", "patio_destino", "movimentacoes", "total_saidas_origem", "pct_transicao"]
    assert df.count() > 0
