"""The registered queries: names, DuckDB oracles, independence of the rest."""

import pathlib
import re

import duckdb
import pytest

from gildhall.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parents[2]


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cur = con.execute(ORACLE[name])
    columns = [c[0] for c in cur.description]
    df = QUERIES[name](spark, SF)
    assert set(columns) == set(df.columns)
    assert sorted(cur.fetchall()) == sorted(tuple(r) for r in df.select(*columns).collect())


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "gildhall").rglob("*.py"):
        if "llm" not in path.parts:
            assert "gildhall.llm" not in path.read_text()
