"""The batch jobs, bronze to gold: each writes its table, the next one reads it."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.fixed import JOURNEY_TAGS, KNOWN_LINE_IDS, RETENTION_DAYS
from linepulse.operators.counts import counts_after, dated, signed, summary_of_counts
from linepulse.operators.gold import SUMMARY_KEYS, notification_targets, summary_rules
from linepulse.operators.governance import tag_columns
from linepulse.operators.journeys import KEYS, PROFILE_COLUMNS, SEQUENCE, journey_batch, profile_rules, table_rows
from linepulse.operators.quality import dq_report, split_by_rules
from linepulse.operators.upsert import scd1
from linepulse.sources import keyed
from linepulse.sources.catalog import (
    BUCKET,
    append,
    append_once,
    buckets_of,
    ensure_table,
    numbers,
    overwrite,
    replace_buckets,
    rows_of,
    seen_by,
    set_properties,
    table_properties,
    with_bucket,
    with_raw,
)
from linepulse.sources.feed import broken, flatten_status, stamp, stream_feed
from linepulse.tables import (
    CUSTOMER_JOURNEYS,
    CUSTOMER_PROFILES,
    DISRUPTION_COUNTS,
    DISRUPTION_SUMMARY,
    FEED_QUARANTINE,
    LINE_STATUS,
    NOTIFICATION_TARGETS,
    PROFILE_REJECTS,
)

PLATFORM_COLUMNS = ["_inserted_at", "_updated_at", "_delete_at"]
#: Property of the summary: the day it was made for, once it has all counted journeys.
SUMMARISED = "platform.summarised_for"


def ingest_status(
    raw: DataFrame, station_lines: DataFrame, schema: str, location: str | None = None
) -> DataFrame:
    """Append the given runs of a feed to bronze; ``raw`` holds ``(run_ts, payload)``.

    All of them, each time it is called: ``ingest_landed`` takes only new documents of a folder.
    """
    spark = raw.sparkSession
    table = ensure_table(spark, LINE_STATUS, schema, location)
    append(flatten_status(raw, station_lines), table, LINE_STATUS)
    return spark.table(table)


class BrokenFeed(ValueError):
    """Documents that could not be read, where the job was told to fail on them."""


def ingest_landed(
    spark: SparkSession,
    folder: str,
    station_lines: DataFrame,
    schema: str,
    checkpoint: str,
    location: str | None = None,
    fail_on_broken: bool = False,
) -> DataFrame:
    """Append the documents that landed in ``folder`` since the last call to bronze.

    ``checkpoint`` is a folder that remembers what was read. Documents that are no JSON array go
    to the quarantine table with file and reason, or stop the job before anything of their batch
    is written. A batch's files carry the name of the stream and the batch's number, so one that is run
    again after a failure replaces what it had written; the last batch is noted on the table as well.
    A checkpoint made anew is another stream, whatever its path.
    """
    table = ensure_table(spark, LINE_STATUS, schema, location)
    aside = ensure_table(spark, FEED_QUARANTINE, schema, location)

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        mark = f"platform.ingested.{stream}"
        noted = {r.key: r.value for r in table_properties(spark, table).collect()}.get(mark, "-1")
        if int(noted) >= batch_id:
            return
        bad = broken(batch)
        n = bad.count()
        if n and fail_on_broken:
            raise BrokenFeed(f"{n} documents in {folder} are no JSON array")
        name = f"{stream}-{batch_id}"
        append_once(stamp(bad, RETENTION_DAYS["operational"], at="run_ts"), aside, FEED_QUARANTINE, name)
        append_once(flatten_status(batch, station_lines), table, LINE_STATUS, name)
        set_properties(spark, table, {mark: str(batch_id)})

    (
        stream_feed(spark, folder)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.table(table)


def replace_profiles(people: DataFrame, schema: str, location: str | None = None) -> DataFrame:
    """Replace the profiles in bronze; ``people`` holds them as received, and ``run_ts``."""
    spark = people.sparkSession
    table = ensure_table(spark, CUSTOMER_PROFILES, schema, location)
    received = [*PROFILE_COLUMNS, "customer_notes"]
    rows = stamp(with_raw(people, received), RETENTION_DAYS["profile"], at="run_ts")
    overwrite(rows, table, CUSTOMER_PROFILES)
    return spark.table(table)


def refresh(
    profiles: DataFrame,
    status: DataFrame,
    schema: str,
    as_of: dt.date | str,
    location: str | None = None,
    line_ids: Sequence[str] = KNOWN_LINE_IDS,
) -> dict[str, DataFrame]:
    """Bring silver and gold up to bronze and return the tables by name.

    Journeys and targets are updated or inserted by key and never deleted, so those of profiles
    that bronze no longer has stay until retention ends. Only buckets with a changed journey are
    rewritten. Profiles that break a rule have no journeys; they go to ``profile_rejects`` with the
    rules' names, and the counts per rule to its property ``platform.expectations``. The summary follows from the journeys that changed, and is otherwise not touched
    until the day of ``as_of`` changes, since its rows end so many days after that. How many of its
    rows break its rules stands in its ``platform.expectations``.

    A run that failed is completed by the next one, which goes on with the same changed journeys.
    ``status`` may be all of bronze or only what is new in it.
    """
    spark: SparkSession = profiles.sparkSession
    tables = {
        spec.name: ensure_table(spark, spec, schema, location)
        for spec in (CUSTOMER_JOURNEYS, DISRUPTION_COUNTS, DISRUPTION_SUMMARY, NOTIFICATION_TARGETS)
    }
    journeys = tables[CUSTOMER_JOURNEYS.name]
    if change := keyed.pending(spark, journeys):
        _carry_on(spark, tables, change, as_of)
    with split_by_rules(profiles.select(*PROFILE_COLUMNS, *PLATFORM_COLUMNS), profile_rules(as_of)) as (good, bad, counts):
        rejects = ensure_table(spark, PROFILE_REJECTS, schema, location)
        overwrite(tag_columns(bad, JOURNEY_TAGS), rejects, PROFILE_REJECTS)
        set_properties(spark, rejects, {"platform.expectations": json.dumps(counts)})
        with journey_batch(good, status, as_of) as versions:
            fresh = table_rows(scd1(versions, KEYS, SEQUENCE))
            change = keyed.prepare(fresh, journeys, CUSTOMER_JOURNEYS)
    if change:
        _carry_on(spark, tables, change, as_of)
    _summarise(spark, tables, as_of, line_ids)
    return {spec.name: rows_of(spark, tables[spec.name]) for spec in (CUSTOMER_JOURNEYS, DISRUPTION_SUMMARY, NOTIFICATION_TARGETS)}


def _carry_on(spark: SparkSession, tables: Mapping[str, str], change: str, as_of: dt.date | str) -> None:
    """Bring a noted change into journeys, counts and targets; every step may be repeated."""
    journeys, counts, targets = (tables[s.name] for s in (CUSTOMER_JOURNEYS, DISRUPTION_COUNTS, NOTIFICATION_TARGETS))
    keyed.apply(spark, journeys, CUSTOMER_JOURNEYS, change)
    pairs = keyed.read_change(spark, journeys, change)
    n = buckets_of(spark, counts)
    images = with_bucket(dated(signed(pairs)), SUMMARY_KEYS, n)
    left = sorted(set(numbers(images)) - seen_by(spark, counts, change))
    if left:
        set_properties(spark, tables[DISRUPTION_SUMMARY.name], {SUMMARISED: ""})
        mine = F.col(BUCKET).isin(left)
        before = spark.table(counts).where(mine).drop(BUCKET)
        with counts_after(before, images.where(mine).drop(BUCKET), rows_of(spark, journeys)) as after:
            replace_buckets(with_bucket(after, SUMMARY_KEYS, n), counts, left, change)
    keyed.upsert_table(notification_targets(pairs.select("_new.*"), as_of), targets, NOTIFICATION_TARGETS)
    keyed.finish(spark, journeys, change)


def _summarise(spark: SparkSession, tables: Mapping[str, str], as_of: dt.date | str, line_ids: Sequence[str]) -> None:
    """Bring the summary up to the counts, where these or the day have changed, and note broken rules."""
    table, counts = tables[DISRUPTION_SUMMARY.name], rows_of(spark, tables[DISRUPTION_COUNTS.name])
    noted = {r.key: r.value for r in table_properties(spark, table).collect()}
    if noted.get(SUMMARISED) != str(as_of):
        keyed.sync(summary_of_counts(counts, as_of), table, DISRUPTION_SUMMARY)
        rules = summary_rules(line_ids)
        report = dq_report(rows_of(spark, table), rules).collect()
        broken_rows = {"rows": report[0]["rows"], **{r["rule"]: r["failed"] for r in report}}
        set_properties(spark, table, {"platform.expectations": json.dumps(broken_rows), SUMMARISED: str(as_of)})
