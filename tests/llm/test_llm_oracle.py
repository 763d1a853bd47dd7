"""The operators that SQL can express, against DuckDB over whole tables."""

import os
import sys

import duckdb
import pytest

from profitlens.llm.oracle import ORACLE_SQL
from profitlens.llm.queries import QUERIES
from llm_cases import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
from oracle_check import rows_of  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows and rows_of(rows, df.columns) == rows_of(res.fetchall(), cols)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
