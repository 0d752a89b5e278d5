import duckdb
import pytest

import __spark_entry__ as entry
from rainledger.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.execute(catalog.oracle_sql()[name])
    columns = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in columns]
    assert sorted(got.columns) == columns
    assert plain(tuple(r[c] for c in columns) for r in got.collect()) == plain(tuple(r[i] for i in order) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
