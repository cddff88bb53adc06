"""Every registered query against its SQL on the smallest data set, and checks of the plans."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from contract import oracle, registry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
QUERIES, SQL = registry.QUERIES, oracle.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _rows(table):
    def plain(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    names = sorted(table.column_names)
    columns = [[plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, Counter(zip(*columns, strict=True))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert _rows(QUERIES[name](spark, SF).toArrow()) == _rows(duck.sql(SQL[name]).to_arrow_table())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 6


def test_sample_is_repeatable(spark):
    first = QUERIES["v43_document_sample"](spark, SF).collect()
    assert len(first) == 3
    assert QUERIES["v43_document_sample"](spark, SF).collect() == first


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BANNED = ["CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"]


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n[0] in "cvmqg"])
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert not [b for b in BANNED if b in plan]
    assert "BroadcastNestedLoopJoin" not in plan


def test_nested_columns_are_pruned(spark):
    plan = _plan(QUERIES["m08_market_stats"](spark, SF))
    assert "struct<prix:struct<valeur:double>,surface:struct<valeur:double>>" in plan
    assert "caracteristiques" not in plan


def test_market_statistics_reach_listings_without_a_join(spark):
    plan = _plan(QUERIES["m10_compare_to_market"](spark, SF))
    assert "Join" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_sizing():
    from parcela.session import sizing

    assert sizing(100 * 1024**4, 4000)["spark.sql.shuffle.partitions"] == "819200"
    assert sizing(10, 8)["spark.sql.shuffle.partitions"] == "16"


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(QUERIES["c02_chiffre_affaires_par_client"](spark, SF))
    assert "l_shipdate" not in plan
    assert "l_tax" not in plan
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    from parcela.plans import search

    shown = orders.selectExpr("o_orderkey AS id_annonce", "o_totalprice AS prix", "o_orderpriority AS type_bien")
    plan = _plan(search.search_filter(shown, min_prix=1000).select("id_annonce"))
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in plan.split("PushedFilters")[1]
    assert "o_orderpriority" not in plan.split("ReadSchema")[1]


def test_a_query_builds_only_the_layers_it_reads(spark):
    from parcela.operators import market

    s = registry.Source(spark, SF)
    assert market.segment_distribution(s.aggregated).count() > 0
    assert {"html", "modules", "listings"} & set(s.__dict__) == {"listings"} and s.html and s.modules
    assert not {"raw", "silver", "prepared"} & set(s.__dict__)
