"""Every query with an oracle, against DuckDB on the same tables."""

import math

import duckdb
import pytest

from tidemark import oracles, registry
from tidemark.sources.warehouse import TABLES

QUERIES = registry.queries()


@pytest.fixture(scope="session")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}" if abs(v) > 1e-9 else "0"
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_duckdb(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    got = rows_of(df.columns, df.collect())
    found = duck.execute(oracles.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(names, found.fetchall())
    assert got


def test_every_query_has_an_oracle_or_a_reason():
    # DuckDB can't see a view's files, whose bytes are counted here.
    assert set(QUERIES) == set(oracles.SQL) | {"catalog_sizes"}
