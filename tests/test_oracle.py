"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from casestar.plans.registry import ORACLE, QUERIES
from scripts.check_oracle import TABLES, rows_of
from tests.test_plans import FORBIDDEN, plan_text


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{small_dir}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


def test_entry_holds_the_library_queries():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["IdBundesland", "IdLandkreis", "id_time", "id_lk_time", "id_bl_time",
                          "Altersgruppe", "Alter_Zahl", "Geschlecht", "Status", "Anzahl"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, small_dir, key):
    df = QUERIES[key](spark, small_dir)
    text = plan_text(df)
    for bad in FORBIDDEN:
        assert bad not in text, (key, bad)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[key])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(rel.columns, drows)
