"""Queries with SQL against DuckDB, whole tables of the smallest size."""
import duckdb
import pytest

from graphloom.llm.oracles import ORACLES
from graphloom.llm.queries import QUERIES
from tests.conftest import SMALL


def canon(rows):
    return sorted(tuple("" if x is None else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    got = canon([[r[c] for c in order] for r in df.collect()])
    assert got == canon([[dict(zip(cols, r))[c] for c in order] for r in res.fetchall()])


def test_all_operators_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14))
