import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from ledgerlight.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.001/{t}.parquet'")
    df = entry.queries()[name](spark, f"{DATA}/sf0.001")
    want = con.sql(queries.ORACLE_SQL[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    rows = lambda data, columns: sorted(tuple(repr(r[columns.index(c)]) for c in order) for r in data)
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)
