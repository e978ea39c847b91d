"""Every registered job against its DuckDB SQL on the smallest tables (the driver runs the same at sf0.01)."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import _rows, duck
from tableops.plans import registry

SF = os.environ.get("TABLEOPS_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {name: fn for name, fn in entry.queries().items() if name in registry.QUERIES}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_job_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows, scols = df.collect(), df.columns
    if name not in SQL:
        pytest.skip("no SQL form")
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(scols, srows) == _rows(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "rank" in df.columns
