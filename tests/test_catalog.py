"""Every registered query of the engine against its SQL, on whole tables."""

import duckdb
import pytest

from textlode.plans import catalog

D = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, con, name):
    df = catalog.queries()[name](spark, D)
    want = con.sql(catalog.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    for c, kind in df.dtypes:
        assert KINDS.get(kind) in (None, str(want.types[want.columns.index(c)])), c
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    assert got == sorted((tuple(plain(r[want.columns.index(c)]) for c in cols) for r in want.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_others_run(spark, name):
    assert catalog.queries()[name](spark, "/root/testdata/sf0.001").count() >= 1


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
