"""Every registered query against its SQL counterpart on the supplied tables."""

import pytest

import __spark_entry__ as contract
from compare import from_duckdb, from_spark
from conftest import SF_ROOT
from hirefunnel.plans.catalogue import QUERIES as OWN

QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


def test_every_query_has_an_oracle():
    # Queries of the optional subpackage that SQL cannot express have tests of their own.
    assert OWN.keys() <= ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    sf_dir = str(SF_ROOT / "sf0.01")
    names, rows = from_spark(QUERIES[name](spark, sf_dir))
    want_names, want = from_duckdb(ORACLE[name], sf_dir)
    assert names == want_names
    assert len(rows) == len(want) > 0
    differing = [(a, b) for a, b in zip(rows, want) if a != b]
    assert not differing, differing[:3]


def test_entry(spark):
    df = contract.entry(spark)
    assert {"dates", "hours", "job_id", "spend_hour", "company_id"} <= set(df.columns)
    assert df.count() > 0
