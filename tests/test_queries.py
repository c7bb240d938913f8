"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import workload
from check import canonical, duck, same_types

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = con.execute(entry.oracle_sql()[name])
    assert same_types(df.dtypes, cursor.description)
    columns = [d[0] for d in cursor.description]
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())
