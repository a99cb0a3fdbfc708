"""Every registered query with an oracle statement agrees with DuckDB on the small driver tables."""

import pytest
from conftest import SF_SMALL
from oracle_harness import compare

from tessera.plans.oracles import ORACLES
from tessera.plans.queries import QUERIES

ORACLED = sorted(k for k in QUERIES if k in ORACLES)
ROWS_ONLY = sorted(k for k in QUERIES if k not in ORACLES)


@pytest.mark.parametrize("name", ORACLED)
def test_matches_oracle(spark, name):
    r = compare(spark, name, QUERIES[name](spark, SF_SMALL), ORACLES[name], SF_SMALL)
    assert r["ok"], r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
