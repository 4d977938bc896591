"""Every catalogue query against its SQL on the smallest standard tables."""

import os

import duckdb
import pytest

from millrace.plans import filesets, queries, records, scalars, surfaces  # noqa: F401

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="standard tables are absent")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, db, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = plain(df.select(*columns).collect())
    if name in queries.SQL:
        cursor = db.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({queries.SQL[name]})")
        assert got == plain(cursor.fetchall())
    else:
        assert got
