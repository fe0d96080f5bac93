"""Registered queries against their SQL on the smallest test tables. QUIZLENS_ORACLES=all runs every query."""

import os

import pytest

import __spark_entry__ as entry
from suite.registry import BASE, ORACLES, QUERIES
from tools.check import rows_of

SF_DIR = "/root/testdata/sf0.001"
SELECTION = ["filter_patterns", "join_self_roles", "agg_basic", "window_dense_rank", "provider_mart_str", "provider_mart_heat",
             "provider_mart_aud", "tracking_question_heat", "funnel_report", "quality_missing_references", "quiz_mart_aud",
             "log_flatten", "test_bank_options"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("QUIZLENS_ORACLES") == "all" else SELECTION)
def test_query_equals_sql(spark, database, name):
    df = entry.queries()[name](spark, SF_DIR)
    database.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in database.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, database.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
