"""Driver contract, and registered queries against their SQL.

``CHECK_ALL=1`` compares every query, otherwise one or a few of each kind.
"""

from __future__ import annotations

import os

import __spark_entry__ as entry
import pytest
from checks.compare import check
from checks.oracle import ORACLE
from checks.workload import QUERIES
from conftest import FOLDER

WITHOUT_SQL = {"src_file_inventory"}
SOME = (
    "src_weather_json", "src_known_files", "src_archive_report", "inc_merge_by_key", "inc_dedup_by_key", "stg_yellow_taxi", "trips_unioned",
    "dim_date", "dim_weather", "dim_location", "fct_trips", "fct_hourly_mobility", "join_star",
    "join_orphan_keys", "fn_numbers", "fn_time", "sem_metric_values", "sem_joined_dimensions",
    "sem_states_all_metrics", "sem_states_joined", "sem_states_daily",
    "dq_checked_writes", "dq_month_status", "dq_date_gaps", "rpt_key_metrics", "rpt_calendar_heatmap",
    "rpt_weather_correlation", "rpt_top_zones", "rpt_raw_weather_ranges",
)


def test_every_query_has_sql_but_for_one():
    assert set(entry.queries()) >= set(QUERIES)
    assert set(QUERIES) - set(entry.oracle_sql()) == WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.count() > 0 and "hour_key" in result.columns


@pytest.mark.parametrize("name", list(ORACLE) if os.environ.get("CHECK_ALL") else SOME)
def test_query_equals_sql(spark, name):
    assert check(spark, FOLDER, name) is None
