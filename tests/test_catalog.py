import os

import pytest

import __spark_entry__ as entry
from glosswright import catalog

SF = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(name.startswith("op_") for name in catalog.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
def test_queries_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    sql = catalog.oracle_sql()

    def norm(rows):
        return sorted(tuple("null" if v is None or v != v else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in rows)

    for name, q in catalog.queries().items():
        if name not in sql:
            continue
        df = q(spark, SF)
        cols = sorted(df.columns)
        want = con.execute(f"select {', '.join(cols)} from ({sql[name]})").fetchall()
        assert norm(df.select(*cols).collect()) == norm(want), name
