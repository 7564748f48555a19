"""Every query against independent SQL over the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def comparable(rows):
    def plain(x):
        if x is None:
            return ""
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(x + 0.0)
        return str(x)

    return sorted(tuple(plain(x) for x in row) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf, name):
    result = QUERIES[name](spark, sf)
    columns = sorted(result.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert comparable(result.select(*[f"`{c}`" for c in columns]).collect()) == comparable(expected)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() == 15


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
