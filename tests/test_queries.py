"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as entry
from compare import difference

from lakepnl.queries import MODULES

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = entry.oracle_sql()


def test_every_query_has_check_sql():
    assert not set(QUERIES) - set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, name):
    rows, problem = difference(spark, sf, entry.queries()[name], ORACLES[name])
    assert not problem
    assert rows > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert "pnl_daily" in df.columns and df.limit(1).count() == 1
