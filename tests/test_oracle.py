"""Every registered query against its SQL over the benchmark tables."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from metropulse.plans import oracle, registry

SF_DIR = os.environ.get("METROPULSE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.statements())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_matches_sql(spark, con, key):
    df = entry_points.queries()[key](spark, SF_DIR)
    assert differences(df, con, entry_points.oracle_sql()[key]) == []


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "LocationID",
        "pickup_hour",
        "FHV",
        "YLC",
        "total",
        "market_share",
        "ratio",
    ]
