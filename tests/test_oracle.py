"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate, run locally)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from eventspark.plans.oracle import ORACLE as CORE_ORACLE
from eventspark.plans.queries import QUERIES as CORE_QUERIES
from conftest import SF001, SF01
from oracle_check import duck, frame_digest

# the library's own queries; those of optional parts have their own tests
QUERIES, ORACLE = CORE_QUERIES, {k: v for k, v in CORE_ORACLE.items() if k in CORE_QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duck(SF01)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    spdf = QUERIES[name](spark, SF01).toPandas()
    opdf = con.execute(ORACLE[name]).df()
    c1, n1, h1, r1 = frame_digest(spdf)
    c2, n2, h2, r2 = frame_digest(opdf)
    assert c1 == c2
    assert n1 == n2
    if h1 != h2:
        diff = sorted(set(r1) ^ set(r2))[:5]
        pytest.fail(f"value mismatch, e.g. {diff}")


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.schema == E.entry(spark).schema
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_on_smallest_scale(spark, name):
    df = QUERIES[name](spark, SF001)
    assert df.count() >= 0
