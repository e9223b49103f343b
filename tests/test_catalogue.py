import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlight.plans import catalogue

from conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    show = lambda v: f"{v:.6f}" if isinstance(v, float) else repr(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, db, name):
    df = entry.queries()[name](spark, f"{DATA}/sf0.001")
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name not in catalogue.ORACLE_SQL:
        assert got
        return
    want = db.sql(catalogue.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == canonical(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
