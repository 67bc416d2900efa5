import duckdb
import pytest

from textlode.llm import queries

D = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, D)
    cols = sorted(want.columns)
    assert sorted(df.columns) == cols
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert [kinds[dict(df.dtypes)[c]] for c in cols] == [str(want.types[want.columns.index(c)]) for c in cols]
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    assert got == sorted((tuple(r[want.columns.index(c)] for c in cols) for r in want.fetchall()), key=str)
