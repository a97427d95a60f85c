"""Every registered query against its DuckDB oracle on the smallest test
tables, plus the entry-point smoke check."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as make
    return make(SF)


def _names():
    from gildhall.plans import QUERIES
    return list(QUERIES)


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    missing = sorted(set(_names()) - set(oracle_sql()))
    assert missing == []
    assert set(_names()) <= set(queries())
    assert len(_names()) >= 90


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import digest
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    a = entry(spark)
    b = entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
