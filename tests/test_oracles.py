"""Every registered query against its SQL twin on the whole small tables."""

import oracle
import pytest

import __spark_entry__ as entry_points
from fleetpulse.plans.oracles import ORACLES as SQL
from fleetpulse.plans.queries import REGISTRY

QUERIES = {name: entry_points.queries()[name] for name in REGISTRY}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert oracle.compare(spark, con, QUERIES[name], SQL[name], sf_dir) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["stat_date", "name", "key", "value"]
