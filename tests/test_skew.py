"""Right results when one key holds a third of all rows."""

import pytest

import __spark_entry__ as entry
from tests.compare import TABLES, compare, duck

# What a third of the rows is made to share, per table.
HOT = {
    "lineitem": {"l_orderkey": "11", "l_partkey": "7", "l_suppkey": "3"},
    "orders": {"o_custkey": "5"},
    "events": {"user_id": "2", "props": """'{"k": 40}'"""},
    "customer": {"c_nationkey": "4"},
}
QUERIES = (
    "q03_top_members_hardware",
    "q05_active_members_in_region",
    "spike_attribution_all",
    "campaign_churn_all",
    "mv_basic_by_tier_and_year",
    "mv_rich_avg_per_member",
    "mv_membership_by_region",
    "mv_conformed_union",
    "dedup_order_lines",
    "result_diff",
    "result_diff_top_n",
    "update_scores",
    "query_history_profile",
    "cost_single_run",
    "cost_prorated",
    "metric_tco",
    "stream_silver_order_lines",
)


@pytest.fixture(scope="module")
def hot_dir(sf_dir, tmp_path_factory):
    target = tmp_path_factory.mktemp("hot")
    connection = duck(sf_dir)
    for table in TABLES:
        columns = HOT.get(table, {})
        swaps = ", ".join(f"CASE WHEN n % 3 = 0 THEN {v} ELSE {c} END AS {c}" for c, v in columns.items())
        rows = f"SELECT *, row_number() OVER () AS n FROM {table}"
        chosen = f"SELECT * EXCLUDE (n){f' REPLACE ({swaps})' if swaps else ''} FROM ({rows})"
        connection.execute(f"COPY ({chosen}) TO '{target}/{table}.parquet' (FORMAT parquet)")
    return str(target)


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys(name, spark, hot_dir):
    assert compare(entry.queries()[name](spark, hot_dir), duck(hot_dir), entry.oracle_sql()[name]) is None
