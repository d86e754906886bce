"""Landed documents to bronze, refreshes that upsert, and tables that streams publish."""

import datetime as dt
import json
import uuid

import pytest
from conftest import SF, at, rows
from pyspark.sql import functions as F

from linepulse.functions.temporal import moment
from linepulse.operators.governance import tags_of
from linepulse.operators.journeys import latest_status
from linepulse.operators.upkeep import expired, purge
from linepulse.operators.upsert import scd1
from linepulse.plans import medallion
from linepulse.plans.registry import QUERIES, bronze_status
from linepulse.scratch import shared_dir
from linepulse.sources import adapter, catalog, feed
from linepulse.streaming import changelog, flows
from linepulse.tables import CUSTOMER_JOURNEYS, LINE_STATUS

GOOD = json.dumps([{"id": "red", "name": "Red", "lineStatuses": [{"statusSeverity": 3}]}])
MAPPING = [("North", ["red", "blue"]), ("South", ["red"])]


@pytest.fixture
def schema(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    yield name, str(tmp_path / "tables")
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "1.json").write_text(GOOD)
    return folder


def ingest(spark, landing, schema, tmp_path, **options):
    mapping = spark.createDataFrame(MAPPING, "station_name string, line_ids array<string>")
    return medallion.ingest_landed(
        spark, str(landing), mapping, schema[0], str(tmp_path / "read"), schema[1], **options
    )


def test_only_new_documents_are_appended(spark, landing, schema, tmp_path):
    assert ingest(spark, landing, schema, tmp_path).count() == 3
    assert ingest(spark, landing, schema, tmp_path).count() == 3
    (landing / "2.json").write_text(GOOD)
    assert ingest(spark, landing, schema, tmp_path).count() == 6


@pytest.mark.parametrize("at_call", ["set_properties", "append_once"])
def test_a_batch_that_failed_is_appended_once(spark, landing, schema, tmp_path, monkeypatch, at_call):
    """Stopped between append and note, and between quarantine and append."""
    (landing / "cut.json").write_text(GOOD[:-3])
    real, seen = getattr(medallion, at_call), []

    def stopping(*args, **kwargs):
        seen.append(args)
        if at_call == "set_properties" or len(seen) == 2:
            raise RuntimeError("stopped")
        return real(*args, **kwargs)

    monkeypatch.setattr(medallion, at_call, stopping)
    with pytest.raises(Exception, match="stopped"):
        ingest(spark, landing, schema, tmp_path)
    monkeypatch.undo()
    assert ingest(spark, landing, schema, tmp_path).count() == 3
    assert spark.table(f"{schema[0]}.feed_quarantine").count() == 1
    assert ingest(spark, landing, schema, tmp_path).count() == 3
    assert "_incoming" not in str(changelog.folders(spark, catalog.location_of(spark, f"{schema[0]}.line_status")))


def test_a_new_checkpoint_at_the_old_path_reads_all(spark, landing, schema, tmp_path):
    assert ingest(spark, landing, schema, tmp_path).count() == 3
    (landing / "2.json").write_text(GOOD)
    assert ingest(spark, landing, schema, tmp_path).count() == 6
    (tmp_path / "read").rename(tmp_path / "lost")
    assert ingest(spark, landing, schema, tmp_path).count() == 12


def test_broken_documents_are_set_aside(spark, landing, schema, tmp_path):
    (landing / "cut.json").write_text(GOOD[:-3])
    (landing / "error.json").write_text('{"status": 429}')
    (landing / "none.json").write_text(" \n")
    assert ingest(spark, landing, schema, tmp_path).count() == 3
    found = spark.table(f"{schema[0]}.feed_quarantine").collect()
    assert sorted((r.file.rsplit("/")[-1], r.reason) for r in found) == [
        ("cut.json", "no readable JSON array"),
        ("error.json", "an object, not an array"),
        ("none.json", "empty"),
    ]
    assert ingest(spark, landing, schema, tmp_path).count() == 3


def test_broken_documents_can_stop_the_job(spark, landing, schema, tmp_path):
    (landing / "error.json").write_text("{}")
    with pytest.raises(Exception, match="no JSON array"):
        ingest(spark, landing, schema, tmp_path, fail_on_broken=True)
    assert spark.table(f"{schema[0]}.line_status").count() == 0


def test_run_times_are_utc_in_any_session(spark, landing):
    import os

    noon = dt.datetime(2024, 7, 1, 12, tzinfo=dt.timezone.utc).timestamp()
    os.utime(landing / "1.json", (noon, noon))
    try:
        for zone in ("UTC", "Europe/London", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert feed.read_feed(spark, str(landing)).first().run_ts == dt.datetime(2024, 7, 1, 12)
            offset = spark.range(1).select(moment("2024-07-01T12:00:00+01:00").alias("t")).first().t
            assert offset == dt.datetime(2024, 7, 1, 11)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


PERSON = (
    "customer_id string, full_name string, email string, date_of_birth date, telephone_number string, "
    "home_postcode string, card_id string, home_station string, customer_notes string, run_ts timestamp_ntz"
)


def people(spark, *ids, run="2024-05-01"):
    born = dt.date(1990, 1, 1)
    return spark.createDataFrame(
        [(i, f"Name {i}", f"a{i}@b.co", born, "07", "AB1 2CD", "9", "North", "", at(run)) for i in ids], PERSON
    )


def test_refresh_updates_and_inserts_but_never_deletes(spark, landing, schema, tmp_path):
    status = ingest(spark, landing, schema, tmp_path)

    def refresh(*ids):
        bronze = medallion.replace_profiles(people(spark, *ids), *schema)
        return medallion.refresh(bronze, status, schema[0], "2024-06-01", schema[1], line_ids=["red"])

    whole = rows(refresh("1", "2", "3", "4")["customer_journeys"])
    assert len(whole) == 8
    assert rows(refresh("1", "2")["customer_journeys"]) == whole
    out = refresh("3", "3", "5")  # a repeated profile gives its keys once
    assert out["customer_journeys"].count() == out["notification_targets"].count() == 10
    again = {k: rows(df) for k, df in out.items()}
    assert {k: rows(df) for k, df in refresh("3", "3", "5").items()} == again
    props = {r.key: r.value for r in catalog.table_properties(spark, f"{schema[0]}.disruption_summary").collect()}
    counts = json.loads(props["platform.expectations"])
    assert counts == {"rows": 2, "disruption_date_not_null": 0, "valid_line_id": 1}
    refresh("3", "")  # customer "" has the address a@b.co: no rule is broken
    broken = people(spark, "9").withColumn("email", F.lit("none"))
    medallion.refresh(medallion.replace_profiles(broken, *schema), status, schema[0], "2024-06-01", schema[1])
    rejects = f"{schema[0]}.profile_rejects"
    assert [(r.customer_id, r.broken_rules) for r in spark.table(rejects).collect()] == [("9", ["valid_email"])]
    props = {r.key: r.value for r in catalog.table_properties(spark, rejects).collect()}
    assert json.loads(props["platform.expectations"])["valid_email"] == 1
    assert tags_of(spark.table(rejects))["email"] == "class.email_address"


def test_overwrite_keeps_comment_and_rows(spark, schema):
    table = catalog.ensure_table(spark, LINE_STATUS, *schema)
    status = bronze_status(spark, SF).limit(50)
    catalog.append(status, table, LINE_STATUS)

    def comment():
        described = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
        return [r.data_type for r in described if r.col_name == "Comment"]

    failing = status.withColumn("status_severity", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        catalog.overwrite(failing, table, LINE_STATUS)
    assert spark.table(table).count() == 50
    catalog.overwrite(spark.table(table).limit(20), table, LINE_STATUS)
    assert spark.table(table).count() == 20
    assert comment() == [LINE_STATUS.comment]
    assert "platform.freshness_sla" in {r.key for r in catalog.table_properties(spark, table).collect()}


def left_behind(spark, label):
    return [n for n in changelog.folders(spark, f"{shared_dir(spark)}/linepulse") if n.startswith(label)]


def test_purge_leaves_no_copy(spark, schema):
    table = catalog.ensure_table(spark, LINE_STATUS, *schema)
    catalog.append(bronze_status(spark, SF), table, LINE_STATUS)
    purge(spark, table, LINE_STATUS, "2026-01-15 00:00:00")
    assert 0 < spark.table(table).count() < bronze_status(spark, SF).count()
    assert expired(spark.table(table), "2026-01-15 00:00:00").count() == 0
    assert left_behind(spark, "new-line_status") == []


def test_the_received_record_stays_in_the_scan(spark, schema):
    table = catalog.ensure_table(spark, LINE_STATUS, *schema)
    catalog.append(bronze_status(spark, SF), table, LINE_STATUS)
    plan = latest_status(spark.table(table))._jdf.queryExecution().executedPlan().toString()
    assert "station_name" in plan
    assert "raw_payload" not in plan
    assert "_delete_at" not in plan


def test_latest_rows_without_the_window_limit(spark):
    status = adapter.status(spark, SF)
    wanted = rows(latest_status(status))
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    try:
        spark.conf.set(limit, "-1")
        df = scd1(status, ["station_name", "line_id"], ["_updated_at", "row_id"])
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString()
        assert rows(latest_status(status)) == wanted
    finally:
        spark.conf.unset(limit)


def test_streams_start_before_their_first_batch(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    assert flows.current_journeys(spark, silver).count() == 0
    flows.stream_notifications(spark, silver, gold, adapter.AS_OF).awaitTermination()
    assert flows.current_targets(spark, gold).count() == 0


def test_streamed_journeys_are_published_and_purged(spark, schema, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "silver")
    status = adapter.status(spark, SF)
    status.repartition(3).write.parquet(landed)
    stream = flows.scan_stream(spark, landed, status.schema, files_per_batch=1)
    flows.stream_journeys(stream, lambda: adapter.profiles(spark, SF), root, adapter.AS_OF).awaitTermination()
    wanted = rows(flows.current_journeys(spark, root))
    table = flows.publish_journeys(spark, root, *schema)
    assert rows(table) == wanted
    assert tags_of(table)["email"] == "class.email_address"
    assert changelog.folders(spark, changelog.log_path(root))
    flows.purge_journeys(spark, root, "2024-06-01 00:00:00")
    assert rows(flows.current_journeys(spark, root)) == wanted
    assert changelog.folders(spark, changelog.log_path(root)) == []
    flows.purge_journeys(spark, root, "2099-01-01 00:00:00")
    assert flows.current_journeys(spark, root).count() == 0
    assert spark.read.schema(flows.JOURNEYS).parquet(f"{root}/state").count() == 0
    status.coalesce(1).write.mode("append").parquet(landed)
    flows.stream_journeys(
        flows.scan_stream(spark, landed, status.schema), lambda: adapter.profiles(spark, SF), root, adapter.AS_OF
    ).awaitTermination()
    assert rows(flows.current_journeys(spark, root)) == wanted
    assert CUSTOMER_JOURNEYS.keys == tuple(flows.KEYS)


ORDERED = {
    "sort_desc": ["affected_customers"],
    "q_severity_distribution": ["affected_customers"],
    "sort_asc_date": ["disruption_date"],
    "q_daily_customer_impact": ["disruption_date"],
    "top_k_stations": ["customers"],
    "q_affected_stations": ["customers"],
}


@pytest.mark.parametrize("name", ORDERED)
def test_order_of_results(spark, name):
    df = QUERIES[name](spark, SF)
    column = next((c for c in ORDERED[name] if c in df.columns), df.columns[1])
    values = [r[column] for r in df.collect()]
    assert values == sorted(values, reverse=column != "disruption_date")
    assert len(set(values)) > 1
