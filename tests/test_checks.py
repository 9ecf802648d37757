"""Every SQL-checked query against its independent SQL on the smallest data."""

import math

import duckdb
import pytest

from chirrup.plans.registry import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
CHECKED = {n: q for n, q in registry().items() if q.check is not None}


@pytest.fixture(scope="module")
def con(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return c


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(CHECKED))
def test_query_matches_sql(spark, folder, con, name):
    query = CHECKED[name]
    df = query.run(spark, folder)
    got = _table(df.columns, df.collect())
    result = con.execute(query.check)
    want = _table([c[0] for c in result.description], result.fetchall())
    assert got == want
