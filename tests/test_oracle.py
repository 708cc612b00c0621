"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, difference, same_type

from batchwork.queries import all_oracles, all_queries

QS = all_queries()
ORS = all_oracles()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


def test_every_key_has_oracle():
    assert set(QS) == set(ORS)


@pytest.mark.parametrize("key", sorted(ORS))
def test_matches_oracle(spark, duck, key):
    df = QS[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORS[key])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert [(c, t, types[c]) for c, t in df.dtypes if not same_type(t, types[c])] == []
    assert difference(df.columns, srows, rel.columns, drows) is None


def test_comparison_sees_small_differences():
    row = (7, 1234567.25, "x")
    assert difference("abc", [row], "abc", [row]) is None
    assert difference("abc", [row], "abc", [(8, 1234567.25, "x")])
    assert difference("abc", [row], "abc", [(7, 1234567.26, "x")])
    assert difference("abc", [(2 ** 53 + 1, 0.0, "x")], "abc", [(2 ** 53, 0.0, "x")])
    assert difference("a", [(float("nan"),)], "a", [(None,)])
    assert not same_type("bigint", "DOUBLE") and not same_type("string", "DATE") and same_type("int", "BIGINT")
