from pathlib import Path

import duckdb
import pytest

from inkmill import oracle, queries

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    df = queries.queries()[name](spark, str(DATA))
    expected = con.sql(oracle.oracle_sql()[name])
    assert set(expected.columns) == set(df.columns)
    assert sorted(str(tuple(r[c] for c in expected.columns)) for r in df.collect()) == sorted(map(str, expected.fetchall()))
