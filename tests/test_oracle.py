"""Every registered query against its SQL twin, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    ours = sorted((tuple(r[n] for n in columns) for r in frame.collect()), key=_key)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(n) for n in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
