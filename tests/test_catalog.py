"""Every registered query against its DuckDB oracle on the smallest tables."""
import pytest

import __spark_entry__ as E
from tests.oracle_check import digest, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "hour" in df.columns


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in sdf.collect()]
    oracle = E.oracle_sql().get(key)
    if oracle is None:
        return
    cur = con.execute(oracle)
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(sdf.columns, rows)[0] == digest(dcols, drows)[0]
