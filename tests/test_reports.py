"""Every report against its SQL on the small tables."""

import pytest
from conftest import SMALL
from oracle import compare, duck

import __spark_entry__ as entry
from tidemark.plans import REPORTS, SQL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


#: Reports that find nothing in the smallest table.
EMPTY = set()


@pytest.mark.parametrize("name", list(REPORTS))
def test_report(spark, con, name):
    problem = compare(REPORTS[name](spark, SMALL), con, SQL[name])
    assert problem == ("no rows" if name in EMPTY else None)


def test_reports_are_registered():
    found, sql = entry.queries(), entry.oracle_sql()
    assert all(found[name] is REPORTS[name] and sql[name] == SQL[name] for name in REPORTS)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
