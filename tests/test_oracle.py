"""Each registered query against its SQL in DuckDB."""

import pytest

from verification import compare
from verification.oracle import oracle_sql
from verification.registry import queries_by_name


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries_by_name()))
def test_matches_sql(spark, con, sf_dir, name):
    if not queries_by_name()[name](spark, sf_dir).columns:
        pytest.fail("no columns")
    assert compare.difference(spark, con, name, sf_dir) in (None, "no rows")


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries_by_name())
