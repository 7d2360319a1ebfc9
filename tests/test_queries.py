"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"

# A choice that covers every kind of query; tools/check.py runs all of them.
SAMPLE = [
    "ingest_bid_requests",
    "ingest_bid_responses",
    "geo_hourly",
    "dq_hourly",
    "landscape_hourly",
    "v_event_enriched_bid_requests",
    "v_agg_serving_metrics",
    "v_agg_funnel_by_publisher",
    "v_agg_impressions_by_geo",
    "q02",
    "q09",
    "q12",
    "q13",
    "q14",
    "q18",
    "chart_rolling_by_bidder",
    "scd2_asof",
    "creative_path",
    "stream_rolling",
    "mat_lookback_repair",
    "mat_indexed_repair",
    "mat_indexed_serving",
    "stream_restart",
    "compaction",
    "stored_funnel",
    "stored_leakage",
    "stream_late_rows",
    "stream_funnel_delta",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, duck, name):
    mine = contract.queries()[name](spark, SF).toArrow()
    want = duck.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert sorted(mine.column_names) == sorted(want.column_names)

    def rows(table):
        names = table.column_names
        return rows_of(names, zip(*[table.column(c).to_pylist() for c in names]))

    assert rows(mine) == rows(want)


def test_every_query_has_sql():
    without = set(contract.LLM_WITHOUT_SQL)
    assert set(contract.queries()) == set(contract.oracle_sql()) | without
    assert not set(contract.oracle_sql()) & without


def test_entry(spark):
    assert contract.entry(spark).columns[:2] == ["hour_start", "publisher_id"]
