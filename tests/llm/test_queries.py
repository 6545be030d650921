"""Queries against their DuckDB statements, as the driver compares them."""
import duckdb
import pytest

from dimweave.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, name):
    got = QUERIES[name](spark, SMALL)
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    rows = sorted(repr(tuple(r[c] for c in order)) for r in got.collect())
    wanted = sorted(repr(tuple(dict(zip(names, r, strict=True))[c] for c in order)) for r in want.fetchall())
    assert rows == wanted
