"""Every registered query against its DuckDB oracle on sf0.001 (the
driver checks sf0.01 the same way)."""

import duckdb
import pytest

import __spark_entry__ as E
from jobstar.plans.catalog import ORACLE, QUERIES
from tools.oracle_check import TABLES, canon
from tools.type_check import SPARK_TO_DUCK

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    scols, srows = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == dtypes
    res = con.execute(E.oracle_sql()[name])
    dcols, drows = canon([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert srows == drows


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["tag", "n_docs"]
    df.collect()
