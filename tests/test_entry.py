"""Every registered query of the library against its SQL, at the smallest scale.

ALL_QUERIES=1 adds those of the training-data operators, which have tests of their own.
"""

import os

import pytest

import __spark_entry__ as entry
from cohortspark.plans.laws import law_queries
from cohortspark.plans.loading import loading_queries
from cohortspark.plans.queries import all_queries
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns[:3] == ["conjunto", "paso", "descripcion"] and df.count() == 26


OTHERS = all_queries() | loading_queries() | law_queries()
NAMES = sorted(entry.queries() if os.environ.get("ALL_QUERIES") else OTHERS)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    if not os.path.isdir(FOLDER):
        pytest.skip("test tables are not here")
    assert compare(spark, con, name, FOLDER) is None
