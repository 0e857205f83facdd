"""Every registered query over damaged copies of the small tables: nulls anywhere, clashing extra columns, empty tables."""

import os

import pytest
from pyspark.sql import functions as F

from glosswright.llm import catalog

SF = "/root/testdata/sf0.001"
TABLES = "analyze_metrics channels chunk_records documents entries eval_items normalize_chunks speakers split_targets toxicity_labels transcript_segments transcripts videos".split()
CLASHES = "g i t k n b x words tokens share kind named turn component __text __keys distance rank lo hi".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


def damaged(spark, folder, empty):
    for name in TABLES:
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        if empty:
            df = df.limit(0)
        elif name != "split_targets":
            hurt = [F.when(F.abs(F.xxhash64(F.lit(c), *df.columns[:3])) % 9 == 0, None).otherwise(F.col(c)).alias(c) for c in df.columns]
            df = df.select(*hurt)
        df = df.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in df.columns])
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("empty", [False, True])
def test_queries_survive_damage(spark, tmp_path, empty):
    sf = damaged(spark, tmp_path / "t", empty)
    for name, query in catalog.queries().items():
        df = query(spark, sf)
        rows = df.count()
        if empty:
            assert rows == 0, name
        elif name.endswith("_found"):
            assert rows == df.distinct().count(), name


def test_queries_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    for name, sql in catalog.oracle_sql().items():
        df = catalog.queries()[name](spark, SF)
        cols = sorted(df.columns)
        want = con.execute(f"select {', '.join(cols)} from ({sql})").fetchall()
        assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, want)), name
