"""Every catalogued query against its SQL, over the whole tables."""

import oracle
import pytest

import __spark_entry__ as driver
from rankfield.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert oracle.compare(spark, sf_dir, QUERIES[name], ORACLES[name]) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= driver.queries().items()


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 11))
    # Document 7 is the most like itself, in both rankings.
    assert next(r["doc_id"] for r in rows if r["rank"] == 1) == 7
