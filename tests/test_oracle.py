"""Every query with SQL, against DuckDB over the smallest data set."""

import pytest
from oracle_check import DATA, compare, duck

import __spark_entry__ as entry

SF = f"{DATA}/sf0.001"
# These train the forecaster with all its rounds; tests/oracle_check.py runs them.
LONG = {"i1_beats_the_mean", "i2_scored_after_loading", "i3_importance_sums", "i3_permutation_holds", "i5_contributions_add_up"}
FNS, SQLS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(SQLS) - LONG))
def test_equals_sql(spark, con, name):
    assert compare(FNS[name](spark, SF), con, SQLS[name]) == ""


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(FNS)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
