"""Every registered query with an oracle agrees with DuckDB at sf0.001; every
rows-only query runs.  (The driver repeats the oracle check at sf0.01.)"""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

_Q = queries()
_O = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(_O))
def test_oracle(spark, con, name):
    problems, _ = compare(spark, SF, name, _Q[name], _O[name], con)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(_Q) - set(_O)))
def test_rows_only(spark, name):
    assert _Q[name](spark, SF).count() >= 1


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(_O) <= set(_Q)
