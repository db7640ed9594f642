"""Every registered query of the engine against its oracle on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import connect, same

from corvane import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, con, name):
    same(QUERIES[name](spark, sf_dir), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_age_is_read_once(spark, sf_dir):
    """The plan of age_vector holds the reading of an age once, however many cells name it."""
    plan = QUERIES["age_vector"](spark, sf_dir)._jdf.queryExecution().analyzed().toString()
    assert plan.count("range_to_uniform_interval") == 1
