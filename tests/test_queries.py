"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_queries import difference, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_matches_sql(spark, name):
    got = spark_rows(contract.queries()[name](spark, SF))
    assert got[1]
    if name in ORACLE:
        assert difference(got, duck_rows(SF, ORACLE[name])) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 5 and sum(r.entries for r in rows) == 1000
