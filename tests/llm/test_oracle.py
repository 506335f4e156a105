"""Corpus queries against their DuckDB twins, on whole small tables."""

import duckdb
import pytest

from casestar.llm.queries import ORACLE, QUERIES
from scripts.check_oracle import rows_of

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")
NATIVE = ("op1_quality_rules", "op5_lookup_sharding", "op8_mixing", "op10_secret_scan")


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_twin(spark, small_dir, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    df = QUERIES[key](spark, small_dir)
    rel = con.sql(ORACLE[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


@pytest.mark.parametrize("key", NATIVE)
def test_native_plans_have_no_python(spark, small_dir, key):
    plan = QUERIES[key](spark, small_dir)._jdf.queryExecution().toString()
    for word in ("Python", "Pandas", "MapInArrow", "CartesianProduct"):
        assert word not in plan
