"""Every registered query against its DuckDB SQL on the small driver data.

The driver runs the same comparison at sf 0.01; here sf 0.001 keeps it fast.
"""

import pytest

import __spark_entry__ as E
from tallyline.plans.registry import ORACLE as SQL
from tallyline.plans.registry import QUERIES
from tools.oracle_check import compare, duck

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    msg = compare(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL, verbose=True)
    assert " OK " in msg or "SPARK-ONLY" in msg, msg


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 58
    assert df.count() > 0
