import pytest
from oracle import spark_rows, sql_rows

import __spark_entry__ as entry
from rangeloom.plans import registered

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_equals_its_sql(spark, name):
    columns, got = spark_rows(registered.QUERIES[name](spark, FOLDER))
    if name in registered.ORACLE:
        want_columns, want = sql_rows(FOLDER, registered.ORACLE[name])
        assert columns == want_columns
        assert got == want
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
