"""Bucketed tables, and the summary that is kept by signed changes."""

import datetime as dt
import random
import uuid
from functools import reduce

import pytest
from conftest import SF, at, rows
from pyspark.sql import functions as F

from linepulse.operators import counts, upkeep
from linepulse.operators.gold import disruption_summary
from linepulse.operators.upsert import upsert
from linepulse.plans import medallion
from linepulse.plans.registry import QUERIES
from linepulse.scratch import folders, shared_dir
from linepulse.sources import adapter, catalog, keyed
from linepulse.tables import CUSTOMER_JOURNEYS, DISRUPTION_COUNTS, DISRUPTION_SUMMARY, NOTIFICATION_TARGETS

AS_OF = "2024-06-01"
SCHEMA = ", ".join(f"{n} {k}" for n, k, _ in CUSTOMER_JOURNEYS.columns)


@pytest.fixture
def schema(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    yield name, str(tmp_path / "tables")
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def journey(customer, line="red", updated="2024-05-01", station="North", severity="Severe", detail="snow", inserted=None):
    """A row of ``customer_journeys``."""
    return (
        customer, "Name", "a@b.co", dt.date(1990, 1, 1), "07", "AB1 2CD", "9", station, line, line and line.title(), 3,
        severity, "reason", detail, "[]", at(inserted or updated) if updated else None, at(updated) if updated else None, 34,
        at("2025-06-01"),
    )


def frame(spark, *journeys):
    return spark.createDataFrame(list(journeys), SCHEMA)


def files(spark, table):
    return set(spark.table(table).inputFiles())


def bucket(spark, table, *customers):
    return set(catalog.numbers(spark.table(table).where(F.col("customer_id").isin(list(customers)))))


@pytest.fixture
def table(spark, schema):
    name = catalog.ensure_table(spark, CUSTOMER_JOURNEYS, *schema)
    keyed.upsert_table(frame(spark, *[journey(str(i)) for i in range(200)]), name, CUSTOMER_JOURNEYS)
    return name


def test_a_batch_leaves_other_buckets_alone(spark, table):
    before, held = files(spark, table), {r.customer_id: r for r in spark.table(table).collect()}
    assert len(held) == 200
    touched = keyed.upsert_table(
        frame(spark, journey("7", updated="2024-05-02"), journey("7", updated="2024-05-01"), journey("8", updated="2024-04-01")),
        table, CUSTOMER_JOURNEYS,
    )
    assert touched == bucket(spark, table, "7")  # customer 8 is late and changes nothing
    same = {f for f in before if f"_bucket={min(touched)}/" not in f}
    assert same == files(spark, table) & before
    assert len(before) - len(same) == 1
    after = {r.customer_id: r for r in spark.table(table).collect()}
    assert after.pop("7")._updated_at == at("2024-05-02")
    assert all(held[c] == r for c, r in after.items())


def test_the_same_batch_again_rewrites_nothing(spark, table):
    before = files(spark, table)
    assert keyed.upsert_table(frame(spark, *[journey(str(i)) for i in range(200)]), table, CUSTOMER_JOURNEYS) == set()
    assert files(spark, table) == before


def test_null_keys_and_repeats_are_one_row(spark, table):
    for _ in range(2):
        keyed.upsert_table(frame(spark, journey(None), journey(None), journey("a", line=None)), table, CUSTOMER_JOURNEYS)
    assert spark.table(table).where("customer_id IS NULL OR line_id IS NULL").count() == 2


def test_a_failed_write_leaves_the_old_rows(spark, table):
    held, left = rows(spark.table(table)), folders(spark, catalog.location_of(spark, table))
    failing = frame(spark, journey("7", updated="2024-07-01")).withColumn("full_name", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        keyed.upsert_table(failing, table, CUSTOMER_JOURNEYS)
    with pytest.raises(Exception, match="boom"):
        catalog.overwrite(failing, table, CUSTOMER_JOURNEYS)
    bad = spark.table(table).withColumn("full_name", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        catalog.replace_buckets(bad, table, range(64), "x")
    assert rows(spark.table(table)) == held
    assert folders(spark, catalog.location_of(spark, table)) == left


def test_a_change_that_stopped_half_way_is_completed(spark, table, monkeypatch):
    new = frame(spark, *[journey(str(i), updated="2024-05-03") for i in range(0, 200, 3)], journey("new"))
    sql, seen = type(spark).sql, []

    def stopping(self, text, *args, **kwargs):
        if "SET LOCATION" in text and "PARTITION" in text:
            seen.append(text)
            if len(seen) == 5:
                raise RuntimeError("stopped")
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", stopping)
    with pytest.raises(RuntimeError, match="stopped"):
        keyed.upsert_table(new, table, CUSTOMER_JOURNEYS)
    monkeypatch.undo()
    assert keyed.pending(spark, table)
    assert spark.table(table).where("_updated_at = '2024-05-03'").count() < 67
    keyed.upsert_table(frame(spark), table, CUSTOMER_JOURNEYS)
    assert not keyed.pending(spark, table)
    assert spark.table(table).where("_updated_at = '2024-05-03'").count() == 67
    assert spark.table(table).count() == 201


def test_upserts_equal_the_batch_form(spark, schema):
    people, status = adapter.profiles(spark, SF), adapter.status(spark, SF)
    all_at_once = rows(QUERIES["scd1_upsert"](spark, SF))
    assert all_at_once
    from linepulse.operators.journeys import customer_journeys

    name = catalog.ensure_table(spark, CUSTOMER_JOURNEYS, *schema)
    half = F.col("_updated_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    target = None
    for part in (status.where(half), status.where(~half), status):
        batch = customer_journeys(people, part, adapter.AS_OF)
        keyed.upsert_table(batch, name, CUSTOMER_JOURNEYS)
        own = batch.withColumn("_came", F.lit(0 if target is None else target[1] + 1))
        held = own if target is None else upsert(target[0], own, CUSTOMER_JOURNEYS.keys, ["_updated_at", "_came"])
        target = (spark.createDataFrame(held.collect(), held.schema), (target or (0, -1))[1] + 1)
    assert rows(catalog.rows_of(spark, name)) == rows(target[0].drop("_came"))


def test_purge_rewrites_buckets_with_expired_rows(spark, table):
    keyed.upsert_table(frame(spark, (*journey("old", updated="2024-06-02")[:-1], at("2024-06-03"))), table, CUSTOMER_JOURNEYS)
    before, place = files(spark, table), bucket(spark, table, "old")
    upkeep.purge(spark, table, CUSTOMER_JOURNEYS, "2024-07-01 00:00:00")
    assert spark.table(table).count() == 200
    gone = before - files(spark, table)
    assert gone and all(f"_bucket={min(place)}/" in f for f in gone)


def test_overwrite_of_another_schema_keeps_rows_through_a_failure(spark, schema, monkeypatch):
    spec = NOTIFICATION_TARGETS
    name = catalog.ensure_table(spark, spec, *schema, buckets=4)
    one = spark.createDataFrame([("1",)], "customer_id string").select(
        *[F.lit("x" if k == "string" else None).cast(k).alias(n) if n != "customer_id" else F.col(n) for n, k, _ in spec.columns]
    )
    keyed.upsert_table(one, name, spec)
    assert "class" in spark.table(name).schema["email"].metadata
    catalog.set_properties(spark, name, {"platform.mark": "kept"})
    sql = type(spark).sql

    def stopping(self, text, *args, **kwargs):
        if "RENAME TO" in text:
            raise RuntimeError("stopped")
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", stopping)
    with pytest.raises(RuntimeError, match="stopped"):
        catalog.overwrite(one.union(one.withColumn("customer_id", F.lit("2"))), name, spec)  # no tags: another schema
    monkeypatch.undo()
    assert catalog.ensure_table(spark, spec, *schema) == name
    assert catalog.rows_of(spark, name).count() == 2
    assert catalog.buckets_of(spark, name) == 4
    assert {r.key: r.value for r in catalog.table_properties(spark, name).collect()}["platform.mark"] == "kept"


# The summary


def test_counts_give_the_summary(spark):
    every = QUERIES["latest_then_join"](spark, SF)
    from linepulse.plans.registry import all_journeys

    every = all_journeys(spark, SF)
    got = counts.summary_of_counts(counts.station_counts(every), adapter.AS_OF)
    assert rows(got) == rows(disruption_summary(every, adapter.AS_OF))


def pairs(spark, changes):
    """``(_old, _new)`` rows as ``image_pairs`` gives them."""
    kind = f"_old struct<{SCHEMA.replace(' ', ': ').replace(',: ', ', ')}>, _new struct<{SCHEMA.replace(' ', ': ').replace(',: ', ', ')}>"
    return spark.createDataFrame(changes, kind)


@pytest.mark.parametrize("seed", range(3))
def test_any_sequence_of_batches_equals_the_whole(spark, seed):
    rng = random.Random(seed)
    state: dict = {}
    held = spark.createDataFrame([], ", ".join(f"{n} {k}" for n, k, _ in DISRUPTION_COUNTS.columns))
    for step in range(5):
        changes = []
        for customer in rng.sample(range(12), 8):
            key = (str(customer) if customer else None, rng.choice(["red", "blue", None]))
            new = journey(
                key[0], key[1], rng.choice(["2024-05-01", "2024-05-01 10:00:00", "2024-05-02", None]),
                rng.choice(["North", "South"]), rng.choice(["Severe", None]), rng.choice(["snow", None]), rng.choice(["2024-04-01", "2024-04-02"]),
            )
            if state.get(key) != new:
                changes.append((state.get(key), new))
                state[key] = new
        now = frame(spark, *state.values())
        with counts.counts_after(held, counts.signed(pairs(spark, changes)), now) as after:
            held = spark.createDataFrame(after.collect(), held.schema)
        assert rows(held) == rows(counts.station_counts(now))
        assert rows(counts.summary_of_counts(held, AS_OF)) == rows(disruption_summary(now, AS_OF))


def test_journeys_are_read_only_where_an_extreme_is_lost(spark):
    first = [journey(str(i), updated="2024-05-01 08:00:00") for i in range(3)]
    unread = frame(spark, *first).where(F.assert_true(F.col("age") < 0, "journeys were read").isNull())
    held = counts.station_counts(frame(spark, *first))
    two_left = pairs(spark, [(first[0], journey("0", updated="2024-05-01 09:00:00"))])
    with counts.counts_after(held, counts.signed(two_left), unread) as after:
        assert [(r.journeys, r.newest, r.oldest_journeys) for r in after.collect()] == [(3, at("2024-05-01 09:00:00"), 2)]
    later = journey("0", updated="2024-05-01 09:00:00")
    held = counts.station_counts(frame(spark, later, *first[1:]))
    moved_away = pairs(spark, [(later, journey("0", updated="2024-05-03"))])
    with pytest.raises(Exception, match="journeys were read"):
        with counts.counts_after(held, counts.signed(moved_away), unread) as after:
            after.collect()


PERSON = (
    "customer_id string, full_name string, email string, date_of_birth date, telephone_number string, "
    "home_postcode string, card_id string, home_station string, customer_notes string, run_ts timestamp_ntz"
)


def test_refresh_follows_only_changes(spark, schema, monkeypatch):
    born = dt.date(1990, 1, 1)

    def people(*ids, station="North"):
        made = [(i, f"N {i}", f"a{i}@b.co", born, "07", "AB1 2CD", "9", station, "", at("2024-05-09")) for i in ids]
        return medallion.replace_profiles(spark.createDataFrame(made, PERSON), *schema)

    mapping = spark.createDataFrame([("North", ["red", "blue"]), ("South", ["red"])], "station_name string, line_ids array<string>")

    def feed(run, severity, line="red"):
        text = f'[{{"id": "{line}", "name": "{line}", "lineStatuses": [{{"statusSeverity": {severity}}}]}}]'
        raw = spark.createDataFrame([(at(run), text)], "run_ts timestamp_ntz, payload string")
        return medallion.ingest_status(raw, mapping, *schema)

    ids = [str(i) for i in range(30)]
    status = feed("2024-05-01", 3)
    for spec in (CUSTOMER_JOURNEYS, DISRUPTION_COUNTS, DISRUPTION_SUMMARY, NOTIFICATION_TARGETS):
        catalog.ensure_table(spark, spec, *schema, buckets=4)
    tables = {s.name: f"{schema[0]}.{s.name}" for s in (CUSTOMER_JOURNEYS, DISRUPTION_COUNTS, DISRUPTION_SUMMARY, NOTIFICATION_TARGETS)}

    def all_files():
        return {t: files(spark, name) for t, name in tables.items()}

    def check(out, as_of=AS_OF):
        journeys = out["customer_journeys"]
        assert rows(out["disruption_summary"]) == rows(disruption_summary(journeys, as_of))
        assert rows(catalog.rows_of(spark, tables["disruption_counts"])) == rows(counts.station_counts(journeys))
        held = rows(journeys.select("customer_id", "line_id", "_updated_at"))
        assert held == rows(out["notification_targets"].select("customer_id", "line_id", "_updated_at"))

    check(medallion.refresh(people(*ids), status, schema[0], AS_OF, schema[1]))
    before = all_files()
    check(medallion.refresh(people(*ids), status, schema[0], AS_OF, schema[1]))
    assert all_files() == before  # nothing new, nothing written
    # One customer comes: one bucket of journeys and of targets.
    check(medallion.refresh(people(*ids, "new"), status, schema[0], AS_OF, schema[1]))
    assert all(1 <= len(files(spark, tables[t]) - before[t]) <= 2 for t in tables)
    # A run that fails after the journeys were replaced: the next one completes it.
    status = feed("2024-05-02", 2)
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "counts_after", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            medallion.refresh(people(*ids), status, schema[0], AS_OF, schema[1])
    assert keyed.pending(spark, tables["customer_journeys"])
    check(medallion.refresh(people(*ids), status, schema[0], AS_OF, schema[1]))
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "_summarise", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            medallion.refresh(people(*ids[:9]), feed("2024-05-03", 1), schema[0], AS_OF, schema[1])
    check(medallion.refresh(people(*ids), status, schema[0], AS_OF, schema[1]))
    # Another day: all rows of the summary end a day later.
    out = medallion.refresh(people(*ids), status, schema[0], "2024-06-02", schema[1])
    check(out, "2024-06-02")
    assert keyed.pending(spark, tables["customer_journeys"]) == ""
    left = [f for f in folders(spark, f"{shared_dir(spark)}/linepulse") if f.startswith(("batch-", "counts-", "rows-"))]
    assert left == []
    assert [f for f in folders(spark, catalog.location_of(spark, tables["customer_journeys"])) if f.startswith("changes")] == []
    assert reduce(lambda a, b: a and b, [out[t].count() > 0 for t in out])
