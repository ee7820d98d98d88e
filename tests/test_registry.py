"""Every registered query against its DuckDB oracle (as the driver checks it),
on the smallest tables so the suite stays quick; the driver runs sf0.01."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from oracle_compare import compare, duck

# The training-data operators have tests of their own.
QUERIES = {k: f for k, f in entry_mod.queries().items() if k not in entry_mod.LLM_QUERIES}
ORACLES = {k: q for k, q in entry_mod.oracle_sql().items() if k not in entry_mod.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems = compare(spark, con, QUERIES[name], ORACLES[name], SF_SMALL)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["op", "n", "total_price"]
    assert {r.op for r in rows} == {"c", "u", "d", "r"}
