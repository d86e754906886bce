"""Journeys: rules, versions, ties, and the ways to join."""

import datetime as dt

import pytest
from conftest import SF, at, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linepulse.operators import journeys as J
from linepulse.operators.gold import disruption_summary
from linepulse.operators.quality import expect_drop
from linepulse.operators.upsert import changes, scd1, upsert
from linepulse.sources import adapter
from linepulse.sources.adapter import AS_OF


@pytest.fixture(scope="module")
def people(spark):
    return adapter.profiles(spark, SF)


@pytest.fixture(scope="module")
def status(spark):
    return adapter.status(spark, SF)


def by_definition(people, status):
    """Join the whole history, then keep the latest version."""
    good = expect_drop(people, J.profile_rules(AS_OF))
    pairs = good.alias("p").join(
        J.disrupted(status).alias("s"), F.col("p.home_station") == F.col("s.station_name")
    )
    versions = pairs.select(
        "p.customer_id",
        "s.line_id",
        "s.disruption_reason",
        F.least("p._updated_at", "s._updated_at").alias("_updated_at"),
        F.col("s._updated_at").alias("_status_updated_at"),
        F.col("s.row_id").alias("_status_row"),
    )
    return scd1(versions, J.KEYS, J.SEQUENCE).select(
        "customer_id", "line_id", "disruption_reason", "_updated_at"
    )


def test_latest_before_the_join_equals_join_then_upsert(people, status):
    fast = J.customer_journeys(people, status, AS_OF)
    wanted = by_definition(people, status)
    assert rows(fast.select(wanted.columns)) == rows(wanted)


def test_salted_join_equals_broadcast_join(people, status, monkeypatch):
    """A third of all customers at one station, and no broadcast."""
    hot = people.withColumn(
        "home_station",
        F.when(F.col("customer_id").cast("long") % 3 == 0, "Station 1").otherwise(F.col("home_station")),
    )
    wanted = rows(J.customer_journeys(hot, status, AS_OF))
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    salted = J.customer_journeys(hot, status, AS_OF)
    assert "_salt" not in salted.columns and "salt" not in salted.columns
    assert rows(salted) == wanted


def test_profiles_of_one_file_are_joined_by_many_tasks(people, status, monkeypatch):
    one = people.unionByName(people.limit(3)).coalesce(1)
    latest = J.latest_status(J.disrupted(status))
    wanted = J.join_profiles_status(one, latest)
    assert wanted.rdd.getNumPartitions() == 1
    monkeypatch.setattr(J, "JOINED_BYTES", 10_000)
    spread = J.join_profiles_status(one, latest)
    sizes = [n for n in spread.rdd.glom().map(len).collect() if n]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 2
    assert rows(spread) == rows(wanted)


def test_repeated_profiles_need_the_upsert_after_the_join(people, status):
    twice = people.unionByName(
        people.withColumn("_updated_at", F.col("_updated_at") - F.expr("interval 1 day"))
    )
    once = J.customer_journeys(twice, status, AS_OF, unique_profiles=False)
    assert rows(once) == rows(J.customer_journeys(people, status, AS_OF))


def test_fanout_counts_every_pair(people, status):
    counted = J.join_fanout(people, J.disrupted(status)).agg(F.sum("pairs")).first()[0]
    pairs = people.join(J.disrupted(status), F.col("home_station") == F.col("station_name"))
    assert counted == pairs.count()


def test_severity_bounds(spark):
    df = spark.createDataFrame([(9,), (10,), (-1,), (None,)], "status_severity int")
    assert sorted(r[0] for r in J.disrupted(df).collect()) == [-1, 9]


def test_profile_rules_bounds(spark):
    good = ("a@b.co", "S", dt.date(1990, 1, 1))
    people = [
        good,
        ("a@b.c", "S", dt.date(1990, 1, 1)),
        ("a@b.co\n", "S", dt.date(1990, 1, 1)),
        (None, "S", dt.date(1990, 1, 1)),
        ("a@b.co", None, dt.date(1990, 1, 1)),
        ("a@b.co", "S", dt.date(1900, 1, 1)),
        ("a@b.co", "S", dt.date(2024, 2, 1)),
        ("a@b.co", "S", None),
    ]
    df = spark.createDataFrame(people, "email string, home_station string, date_of_birth date")
    assert [tuple(r) for r in expect_drop(df, J.profile_rules(AS_OF)).collect()] == [good]


def test_recent_days_include_the_first_day(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 2, 1)]
    df = spark.createDataFrame([(d,) for d in days], "disruption_date date")
    assert sorted(r[0] for r in J.recent_days(df, AS_OF).collect()) == days[1:]


VERSION = st.tuples(
    st.sampled_from("ab"), st.sampled_from("xy"), st.integers(0, 5), st.integers(0, 1000)
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(VERSION, min_size=1, max_size=20, unique_by=lambda v: v[3]), st.randoms())
def test_upsert_depends_neither_on_order_nor_on_batches(spark, versions, rnd):
    schema = "customer_id string, line_id string, at int, row int"
    keys, order = J.KEYS, ["at", "row"]
    best = {}
    for v in versions:
        best[v[:2]] = max(best.get(v[:2], v), v, key=lambda x: x[2:])
    mixed = versions[:]
    rnd.shuffle(mixed)
    cut = rnd.randint(0, len(mixed))
    first = scd1(spark.createDataFrame(mixed[:cut], schema), keys, order)
    batch = spark.createDataFrame(mixed[cut:], schema)
    once = upsert(first, batch, keys, order)
    assert {tuple(r) for r in once.collect()} == set(best.values())
    assert rows(upsert(once, batch, keys, order)) == rows(once)


def test_changes(spark):
    schema = "id int, v string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (5, "e")], schema)
    assert rows(changes(old, new, ["id"])) == rows(
        spark.createDataFrame(
            [("update", 2, "B"), ("update", 3, "c"), ("delete", 4, "d"), ("insert", 5, "e")],
            "_change_type string, id int, v string",
        )
    )


def test_summary_takes_the_oldest_and_describes_the_newest(spark):
    schema = (
        "customer_id string, home_station string, line_id string, line_name string, "
        "status_severity_description string, disruption_description string, "
        "_inserted_at timestamp_ntz, _updated_at timestamp_ntz"
    )
    early, late = at("2024-01-02 01:00:00"), at("2024-01-02 23:59:59")
    df = spark.createDataFrame(
        [
            ("1", "A", "red", "Red", "Minor", "old", early, early),
            ("2", "B", "red", "Red", "Minor", "new", early, late),
            (None, "B", "red", "Red", "Minor", "old", late, early),
        ],
        schema,
    )
    (row,) = disruption_summary(df, AS_OF).collect()
    assert (row.affected_customers, row.affected_stations) == (2, 2)
    assert (row.disruption_description, row.last_updated) == ("new", late)
    assert (row._inserted_at, row._updated_at) == (early, early)
    assert row._delete_at == at("2026-01-31 00:00:00")


def test_status_filter_reaches_the_files(spark, people, tmp_path):
    adapter.status(spark, SF).write.parquet(str(tmp_path / "status"))
    bronze = spark.read.parquet(str(tmp_path / "status"))
    plan = J.latest_status(J.disrupted(bronze))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(status_severity,10)" in plan
    assert "WindowGroupLimit" in plan


def test_heavy_stations_are_dealt_out(spark):
    """A third of all customers at one station: no task is far above the median, and rows are those of the broadcast."""
    people = adapter.profiles(spark, SF).limit(1).crossJoin(spark.range(30_000)).withColumns(
        {
            "customer_id": F.col("id").cast("string"),
            "home_station": F.when(F.col("id") % 3 == 0, "Hub").otherwise(F.concat(F.lit("S"), F.col("id") % 40)),
        }
    ).drop("id")
    names = ["Hub", *(f"S{i}" for i in range(40)), "Nobody"]
    one = J.with_row_id(adapter.status(spark, SF)).limit(2)
    status = one.crossJoin(spark.createDataFrame([(n,) for n in names], "name string")).withColumn("station_name", F.col("name")).drop("name")
    parts = {r.station: r.parts for r in J.station_parts(people, 1000).collect()}
    assert parts == {"Hub": 10}
    split = J.join_split(people, status, 1000)
    sizes = [r["count"] for r in split.groupBy("p.home_station", "p.part").count().collect()]
    assert len(sizes) > 40 and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]
    got = split.select("p.customer_id", "s.station_name", "s.line_id", "s.row_id")
    on_station = people.join(F.broadcast(status), people.home_station == status.station_name)
    assert rows(got) == rows(on_station.select("customer_id", "station_name", "line_id", "row_id"))
