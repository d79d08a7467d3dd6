"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from faceoff.plans.registry import QUERIES
from oracle import duck, duck_digest, spark_digest

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(NAMES) == 60


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = spark_digest(E.queries()[name](spark, SF_SMALL))
    want = duck_digest(con, E.oracle_sql()[name])
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["team", "conference", "division"]
    assert len(df.collect()) == 32
