"""Tables in the catalog, snapshots, retention, freshness."""

import dataclasses
import datetime as dt
import json
import uuid

import pytest
from conftest import SF, at, rows
from pyspark.sql import functions as F

from linepulse.functions.temporal import age_years, retention_days, sla_interval
from linepulse.operators import upkeep
from linepulse.operators.governance import tags_of
from linepulse.operators.journeys import customer_journeys
from linepulse.plans import medallion
from linepulse.plans.registry import bronze_status
from linepulse.sources import adapter, catalog, feed, snapshots
from linepulse.streaming import flows
from linepulse.tables import ALL_TABLES, CUSTOMER_JOURNEYS, LINE_STATUS

NOW = "2024-06-01 12:00:00"


@pytest.fixture
def schema(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    return name, str(tmp_path / "tables")


def props(spark, table):
    return {r.key: r.value for r in catalog.table_properties(spark, table).collect()}


def test_every_table_can_be_created_twice(spark, schema):
    for spec in ALL_TABLES:
        for _ in range(2):
            table = catalog.ensure_table(spark, spec, *schema)
        assert catalog.rows_of(spark, table).columns == spec.column_names
        assert catalog.buckets_of(spark, table) == spec.buckets
        assert props(spark, table)["platform.freshness_sla"] == spec.freshness_sla
        comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {table}").collect()}
        assert comments["_updated_at"]


def test_specs_are_keys_of_dictionaries():
    named = {spec: spec.name for spec in ALL_TABLES}
    assert [named[spec] for spec in ALL_TABLES] == [spec.name for spec in ALL_TABLES]
    other = dataclasses.replace(CUSTOMER_JOURNEYS, tags={})
    assert other != CUSTOMER_JOURNEYS and other not in named


def test_properties_survive_append_and_overwrite(spark, schema):
    table = catalog.ensure_table(spark, LINE_STATUS, *schema)
    status = bronze_status(spark, SF)
    catalog.append(status, table, LINE_STATUS)
    catalog.append(status, table, LINE_STATUS)
    assert spark.table(table).count() == 2 * status.count()
    catalog.overwrite(status, table, LINE_STATUS)
    assert rows(spark.table(table)) == rows(catalog.conform(status, LINE_STATUS))
    assert props(spark, table)["platform.freshness_sla"] == "30m"


def test_purge_removes_what_has_ended(spark, schema):
    table = catalog.ensure_table(spark, LINE_STATUS, *schema)
    catalog.append(bronze_status(spark, SF), table, LINE_STATUS)
    end = spark.table(table).agg(F.min("_delete_at")).first()[0]
    before = spark.table(table).count()
    assert upkeep.expired(spark.table(table), str(end)).count() == 1
    upkeep.purge(spark, table, LINE_STATUS, str(end))
    assert spark.table(table).count() == before - 1


def test_time_shift_keeps_gaps(spark):
    status = bronze_status(spark, SF)
    moved = snapshots.time_shift(status, NOW)
    assert moved.agg(F.max("_inserted_at")).first()[0] == at(NOW)
    gap = status.join(moved.withColumnRenamed("_inserted_at", "new"), "row_id").select(
        (F.col("new") - F.col("_inserted_at")).alias("gap")
    )
    assert gap.distinct().count() == 1
    ends = moved.filter("_delete_at <> _inserted_at + interval 730 days")
    assert ends.isEmpty()


def test_reload_guard(spark, schema, tmp_path):
    table = catalog.ensure_table(spark, LINE_STATUS, *schema)
    path = str(tmp_path / "snapshot")
    snapshots.export_snapshot(catalog.conform(bronze_status(spark, SF), LINE_STATUS), path)
    assert snapshots.reload_snapshot(spark, path, table, NOW)
    loaded = spark.table(table).count()
    with pytest.raises(snapshots.AlreadyLoaded):
        snapshots.reload_snapshot(spark, path, table, NOW)
    assert not snapshots.reload_snapshot(spark, path, table, NOW, quiet=True)
    assert spark.table(table).count() == loaded
    assert snapshots.reload_snapshot(spark, path, table, NOW, force=True)
    assert spark.table(table).count() == 2 * loaded


def test_freshness(spark):
    df = spark.createDataFrame([(at("2024-06-01 11:30:00"),)], "_updated_at timestamp_ntz")
    tables = {"on_time": (df, "30m"), "late": (df, "29m"), "wrong": (df, "soon"),
              "empty": (df.limit(0), "1d"), "day": (df, "1d"), "hour": (df, "1h")}
    status = {r.table_name: r.status for r in upkeep.freshness(tables, NOW).collect()}
    assert status == {"on_time": "fresh", "late": "stale", "wrong": "stale", "empty": "stale",
                      "day": "fresh", "hour": "fresh"}


def test_agreements_and_retention(spark):
    df = spark.createDataFrame([("30m",), ("2h",), ("1d",), ("x",), ("5",)], "t string")
    found = [r[0] for r in df.select(sla_interval(F.col("t"))).collect()]
    assert found == [dt.timedelta(minutes=30), dt.timedelta(hours=2), dt.timedelta(days=1), None, None]
    df = spark.createDataFrame([("operational",), ("alerting",), ("other",)], "p string")
    assert [r[0] for r in df.select(retention_days(F.col("p"))).collect()] == [730, 365, None]


def test_age_turns_on_the_birthday(spark):
    births = [dt.date(1990, 2, 1), dt.date(1990, 2, 2), dt.date(1992, 2, 29)]
    df = spark.createDataFrame([(b,) for b in births], "b date")
    assert [r[0] for r in df.select(age_years(F.col("b"), "2024-02-01")).collect()] == [34, 33, 31]


def test_batch_from_landed_feed_to_gold(spark, schema, tmp_path):
    """Documents in files, through every table, twice."""
    landing = tmp_path / "landing"
    landing.mkdir()
    bad = [{"id": "red", "name": "Red", "lineStatuses": [{"statusSeverity": 3, "reason": "snow"}]}]
    (landing / "1.json").write_text(json.dumps(bad))
    mapping = spark.createDataFrame(
        [("North", ["red", "blue"]), ("South", ["red"])], "station_name string, line_ids array<string>"
    )
    people = spark.createDataFrame(
        [
            ("1", "Ann", "ann@b.co", dt.date(1990, 1, 1), "07000", "AB1 2CD", "9", "North", "", at(NOW)),
            ("2", "Bo", "bo@b", dt.date(1990, 1, 1), "07001", "AB1 2CD", "8", "South", "", at(NOW)),
        ],
        "customer_id string, full_name string, email string, date_of_birth date, "
        "telephone_number string, home_postcode string, card_id string, home_station string, "
        "customer_notes string, run_ts timestamp_ntz",
    )
    for run in (1, 2):
        status = medallion.ingest_status(feed.read_feed(spark, str(landing)), mapping, *schema)
        assert status.count() == 3 * run
        bronze = medallion.replace_profiles(people, *schema)
        assert json.loads(bronze.filter("customer_id = '1'").first().raw_payload)["email"] == "ann@b.co"
        out = medallion.refresh(bronze, status, schema[0], "2024-06-01", schema[1])
    journeys = out["customer_journeys"]
    assert tags_of(journeys)["email"] == "class.email_address"
    assert set(tags_of(out["notification_targets"])) == {"full_name", "email"}
    found = journeys.select("customer_id", "line_id", "status_severity", "disruption_reason")
    assert rows(found) == rows(
        spark.createDataFrame([("1", "red", 3, "snow"), ("1", "blue", -1, "")], found.schema)
    )
    assert out["disruption_summary"].count() == out["notification_targets"].count() == 2
    table = f"{schema[0]}.customer_journeys"
    assert props(spark, table)["platform.freshness_sla"] == "1d"
    comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {table}").collect()}
    assert comments["age"] == "Whole years"


def test_bronze_table_as_a_stream(spark, schema, tmp_path):
    table = catalog.ensure_table(spark, LINE_STATUS, *schema)
    status = bronze_status(spark, SF)
    catalog.append(status, table, LINE_STATUS)
    people, root = adapter.profiles(spark, SF), str(tmp_path / "silver")
    stream = spark.readStream.table(table)
    flows.stream_journeys(stream, lambda: people, root, adapter.AS_OF).awaitTermination()
    wanted = customer_journeys(people, status, adapter.AS_OF)
    assert rows(flows.current_journeys(spark, root)) == rows(wanted)
