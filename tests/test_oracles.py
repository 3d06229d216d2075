"""Every registered query vs. its DuckDB oracle on the sf0.01 tables."""

import duckdb
import pytest

from tests.conftest import SF01
from tools.oracle_check import TABLES, duck_rows, spark_rows, type_mismatches

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_a_callable():
    assert len(QUERIES) >= 50
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    cols, rows = spark_rows(df)
    ocols, orows = duck_rows(con, ORACLES[name])
    assert cols == ocols
    assert type_mismatches(df, con, ORACLES[name]) == {}
    assert len(rows) == len(orows)
    assert rows == orows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF01)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = contract.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["vec_id", "label", "dist", "quality", "toxic"]


def test_content_join_keeps_missing_rows(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    rows = {r.page_id: r.n_bytes for r in QUERIES["content_join"](spark, SF01).collect()}
    assert rows == {i: None if i % 10 == 0 or t is None else len(t.encode()) for i, t in pages.items()}
    assert None in rows.values()


@pytest.mark.parametrize("name", ["ivf_search", "pq_search", "sq_search"])
def test_recall_of_registered_searches(spark, name):
    truth = QUERIES["ivf_search_all_probes"](spark, SF01).select("query_id", "vec_id").collect()
    found = {tuple(r) for r in QUERIES[name](spark, SF01).select("query_id", "vec_id").collect()}
    assert len({r.query_id for r in truth}) > 5
    assert sum(tuple(r) in found for r in truth) >= 0.9 * len(truth)
