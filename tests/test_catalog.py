"""Every registered query against the SQL that expresses the same thing."""

import pytest
from compare import difference, oracle

from txnwatch.plans.catalog import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, sf_dir, con, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    assert difference(ours, con.execute(ORACLE_SQL[name]).fetchdf()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
