"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as entry
import check
from tidemark import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, con, name):
    said = check.compare(catalog.queries()[name](spark, SF_DIR), con, catalog.oracle_sql()[name])
    assert said == "", said


def test_every_query_has_sql_and_the_flagship_runs(spark):
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert entry.entry(spark).columns == ["id_2", "new_count"]
