"""Feed documents written by hand."""

import json
import time

from conftest import at

from linepulse.sources import feed
from linepulse.sources.feed import flatten_status

STATIONS = [("North", ["red", "blue"]), ("South", ["red"]), ("East", ["green", "grey"])]
RUN = "2024-03-01 08:15:00"


def flat(spark, *payloads):
    raw = spark.createDataFrame(
        [(at(f"2024-03-0{i} 08:15:00"), p) for i, p in enumerate(payloads, 1)],
        "run_ts timestamp_ntz, payload string",
    )
    mapping = spark.createDataFrame(STATIONS, "station_name string, line_ids array<string>")
    return flatten_status(raw, mapping)


def line(line_id, *statuses, **more):
    return {"id": line_id, "name": line_id.title(), "lineStatuses": list(statuses), **more}


def one(df, line_id, station="North"):
    found = df.filter(f"line_id = '{line_id}' and station_name = '{station}'").collect()
    assert len(found) == 1
    return found[0]


def test_fields_of_good_and_disrupted_lines(spark):
    stops = [{"commonName": "A", "name": "x"}, {"name": "Bé"}, {}]
    bad = {
        "statusSeverity": 6,
        "statusSeverityDescription": "Severe Delays",
        "reason": "signal",
        "disruption": {"description": "late", "affectedStops": stops},
    }
    good = {"statusSeverity": 10, "statusSeverityDescription": "Good Service"}
    df = flat(spark, json.dumps([line("red", good), line("blue", bad, extra={"kept": [1]})]))
    assert df.count() == 5
    red = one(df, "red")
    assert (red.status_severity, red.disruption_reason, red.disruption_description) == (10, "", "")
    assert json.loads(red.affected_stops_json) == []
    assert one(df, "red", "South").line_name == "Red"
    blue = one(df, "blue")
    assert (blue.status_severity, blue.status_severity_description) == (6, "Severe Delays")
    assert (blue.disruption_reason, blue.disruption_description) == ("signal", "late")
    assert json.loads(blue.affected_stops_json) == ["A", "Bé", ""]
    assert json.loads(blue.raw_payload)["extra"] == {"kept": [1]}
    assert blue._inserted_at == blue._updated_at == at(RUN)
    assert blue._delete_at == at("2026-03-01 08:15:00")


def test_only_the_first_status_counts(spark):
    df = flat(spark, json.dumps([line("red", {"statusSeverity": 9}, {"statusSeverity": 3})]))
    assert one(df, "red").status_severity == 9


def test_defaults_without_status_record_or_disruption(spark):
    feed = [
        line("red"),
        {"id": "blue", "name": "Blue"},
        line("green", {"statusSeverity": "7", "disruption": None}),
    ]
    df = flat(spark, json.dumps(feed))
    for line_id, station in (("red", "North"), ("blue", "North"), ("grey", "East")):
        row = one(df, line_id, station)
        assert (row.status_severity, row.status_severity_description) == (-1, "Unknown")
        assert (row.disruption_reason, row.affected_stops_json) == ("", "[]")
    grey = one(df, "grey", "East")
    assert (grey.line_name, grey.raw_payload) == ("grey", "{}")
    green = one(df, "green", "East")
    assert (green.status_severity, green.disruption_description) == (7, "")


def test_the_last_of_a_repeated_line_counts(spark):
    twice = [line("red", {"statusSeverity": 4}), line("red", {"statusSeverity": 8})]
    assert one(flat(spark, json.dumps(twice)), "red").status_severity == 8


def test_empty_feed_gives_every_pair_and_broken_feed_none(spark):
    df = flat(spark, "[]", "not json", None)
    assert df.count() == 5
    assert {r.status_severity for r in df.collect()} == {-1}


def test_large_documents_take_linear_time(spark):
    """10,000 records, half of them repeated, and 10,000 mapped lines."""
    records = [{"id": f"l{i % 5000}", "name": f"n{i}"} for i in range(10_000)] + [{"name": "no id"}, None]
    raw = spark.createDataFrame([(at("2024-05-01"), json.dumps(records))] * 2, "run_ts timestamp_ntz, payload string")
    pairs = spark.range(10_000).selectExpr("concat('station', id % 9) AS station_name", "concat('l', id + 2500) AS line_id")
    started = time.time()
    found = feed.line_records(raw, pairs).collect()
    assert time.time() - started < 60
    assert len(found) == 20_000
    named = {r.line_id: r.raw_record and json.loads(r.raw_record)["name"] for r in found}
    assert named["l2500"] == "n7500" and named["l4999"] == "n9999"
    assert named["l5000"] is None and named["l12499"] is None
