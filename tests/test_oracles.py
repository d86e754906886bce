"""Each registered query against its SQL, on the smallest scale."""

import pytest
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck
from linepulse.plans.registry import QUERIES

INVENTORY = """
scan_static scan_stream flatten_status records_to_bronze keep_raw_payload stamp_platform_cols
create_table_idempotent reconcile_properties append_sink overwrite_sink snapshot_export
snapshot_reload time_shift reload_guard filter_disrupted project_journey project_notification
filter_not_null filter_email_valid filter_dob_plausible filter_recent_days filter_known_lines
join_profiles_status lookup_line_status latest_then_join disruption_summary agg_count_nonnull
agg_count_distinct agg_first agg_max agg_min count_rows q_disruptions_by_line
q_daily_customer_impact q_severity_distribution q_customers_to_alert q_affected_stations
q_scorecard_30d q_notification_counter w_events_by_line w_daily_trend w_severity_breakdown
sort_desc sort_asc_date top_k_stations fn_age_years fn_retention_stamp fn_oldest_of fn_to_date
fn_cast fn_json_write fn_json_navigate fn_array_map fn_rlike fn_in_list fn_interval_sub fn_ts_add
expect_warn expect_drop dq_report scd1_upsert stream_journeys stream_notifications
changed_rows_feed mask_name mask_email mask_dob mask_postcode mask_for_audience tag_columns
pii_scan notes_explode notes_own_pii freshness_status retention_purge retention_by_purpose
profile_metrics drift_metrics
""".split()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_inventory_is_registered():
    assert set(INVENTORY) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    state, _, _, note = compare(spark, con, SF, name)
    assert state == "ok", note


def test_entry(spark):
    assert entry(spark).columns == ["line_name", "total_affected_customers", "disruption_events"]
    assert entry(spark).count() > 0
