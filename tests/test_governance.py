"""Rules, tags, masks, notes and profiles over time."""

import datetime as dt

from conftest import SF, at, rows
from pyspark.sql import functions as F

from linepulse.fixed import JOURNEY_TAGS, KNOWN_LINE_IDS
from linepulse.functions import masks
from linepulse.operators import governance, observe, quality
from linepulse.sources import adapter


def test_expectations_count_null_as_failed_and_keep_rows(spark, tmp_path):
    df = spark.createDataFrame([("bakerloo",), ("x",), (None,)], "line_id string")
    rules = {"known": F.col("line_id").isin(list(KNOWN_LINE_IDS)), "given": F.col("line_id").isNotNull()}
    checked, seen = quality.expect_warn(df, rules, "test-expectations")
    checked.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert seen.get == {"rows": 3, "known": 2, "given": 1}
    report = {r.rule: (r.rows, r.failed) for r in quality.dq_report(df, rules).collect()}
    assert report == {"known": (3, 2), "given": (3, 1)}
    assert quality.expect_drop(df, rules).count() == 1
    empty = quality.dq_report(df.limit(0), rules).collect()
    assert [(r.rows, r.failed, r.failed_fraction) for r in empty] == [(0, 0, None)] * 2


def test_masks(spark):
    df = spark.createDataFrame(
        [("Ann", "john@example.com", dt.date(1990, 7, 3), " SO17 1BJ "), (None, None, None, None)],
        "n string, e string, d date, p string",
    )

    def masked(frame):
        return frame.select(
            masks.mask_name(F.col("n")).alias("n"), masks.mask_email(F.col("e")).alias("e"),
            masks.mask_birth(F.col("d")).alias("d"), masks.mask_postcode(F.col("p")).alias("p"),
        )

    once = masked(df)
    assert [tuple(r) for r in once.collect()] == [
        ("***MASKED***", "****@*******.***", dt.date(1990, 1, 1), "SO17"), (None,) * 4
    ]
    assert rows(masked(once)) == rows(once)


def test_tags_follow_columns_and_drive_masks(spark, tmp_path):
    people = adapter.profiles(spark, SF)
    tagged = governance.tag_columns(governance.tag_columns(people, JOURNEY_TAGS), JOURNEY_TAGS)
    tagged.write.parquet(str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert governance.tags_of(back) == JOURNEY_TAGS
    for audience in ("pii-readers", "data-stewards"):
        assert rows(governance.mask_for_audience(back, audience)) == rows(people)
    hidden = governance.mask_for_audience(back, "standard-readers")
    assert hidden.columns == people.columns
    assert governance.tags_of(hidden) == JOURNEY_TAGS
    assert hidden.select("full_name").distinct().count() == 1
    assert rows(hidden.select("customer_id", "card_id")) == rows(people.select("customer_id", "card_id"))


def test_scan_finds_classes_and_proposes_untagged_columns(spark):
    df = spark.createDataFrame(
        [("write to a.b@c.org", "07123456789"), ("at @ home", "SO17 1BJ"), (None, "+447123456789")],
        "text string, contact string",
    )
    tagged = governance.tag_columns(df, {"contact": "class.phone_number"})
    found = {
        (r.column_name, r.tag): (r.rows, r.matches, r.proposed)
        for r in governance.pii_scan(tagged, ["text", "contact"]).collect()
    }
    assert found["text", "class.email_address"] == (2, 1, True)
    assert found["text", "class.phone_number"] == (2, 0, False)
    assert found["contact", "class.phone_number"] == (3, 2, False)
    assert found["contact", "class.location"] == (3, 1, False)


NOTES = (
    "[2024-01-02 | Staff] First line.\n\nStill the first, for Ann.\n\n"
    "[2024-02-03 | Customer] Call 07000.\n\n[2024-03-04 | Robot] odd"
)


def test_notes(spark):
    df = spark.createDataFrame(
        [("1", "Ann", "a@b.co", "07000", None, NOTES)],
        "customer_id string, full_name string, email string, telephone_number string, "
        "home_postcode string, customer_notes string",
    )
    entries = governance.explode_notes(df.select("customer_id", "customer_notes")).orderBy("pos")
    assert [tuple(r) for r in entries.collect()] == [
        ("1", 0, dt.date(2024, 1, 2), "Staff", "First line.\n\nStill the first, for Ann."),
        ("1", 1, dt.date(2024, 2, 3), "Customer", "Call 07000."),
        ("1", 2, None, None, "[2024-03-04 | Robot] odd"),
    ]
    own = governance.notes_own_pii(df).orderBy("pos").select("pos", "tag").collect()
    assert [tuple(r) for r in own] == [(0, "class.name"), (1, "class.phone_number")]


def test_profile_and_drift(spark):
    schema = "ts timestamp_ntz, n int, t string"
    df = spark.createDataFrame(
        [
            (at("2024-01-01 00:00:00"), 9, "b"),
            (at("2024-01-01 23:59:59"), 10, None),
            (at("2024-01-01 12:00:00"), 10, "a"),
            (at("2024-01-03 00:00:00"), None, "a"),
        ],
        schema,
    )
    profile = observe.profile_metrics(df, "ts", ["n", "t"])
    got = {(r.column_name, r.window_start.day): r for r in profile.collect()}
    first = got["n", 1]
    assert (first.rows, first.nulls, first.distinct_values) == (3, 0, 2)
    assert (first.min_value, first.max_value) == ("9", "10")
    assert first.mean_value == 29 / 3
    text = got["t", 1]
    assert (text.nulls, text.min_value, text.max_value, text.mean_value) == (1, "a", "b", None)
    empty = got["n", 3]
    assert (empty.rows, empty.nulls, empty.min_value, empty.mean_value) == (1, 1, None, None)
    drift = {r.column_name: r for r in observe.drift_metrics(profile).collect()}
    assert drift["n"].rows_change == -2 and drift["n"].null_share_change == 1.0
    assert drift["n"].mean_change is None
    assert drift["t"].distinct_change == -1
