"""Registered queries against their SQL on the smallest data set."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from parcela.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def rows(table):
    return Counter(zip(*(table.column(n).to_pylist() for n in sorted(table.column_names)), strict=True)), sorted(table.column_names)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert rows(QUERIES[name](spark, SF).toArrow()) == rows(con.sql(SQL[name]).to_arrow_table())


def test_one_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
