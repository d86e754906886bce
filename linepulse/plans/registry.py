"""Every operator as a query over the supplied tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.fixed import (
    EMAIL_PATTERN,
    JOURNEY_TAGS,
    RECENT_DAYS,
    RETENTION_DAYS,
    TARGET_TAGS,
    TS,
)
from linepulse.functions import masks
from linepulse.functions.payload import LINE_RECORD, json_text, line_fields, stop_names
from linepulse.functions.temporal import (
    age_years,
    moment,
    oldest_of,
    plus_days,
    recent,
    retention_days,
    retention_stamp,
)
from linepulse.operators import counts, drift, gold, governance, journeys, observe, quality, sketches, upkeep
from linepulse.operators import upsert as keyed
from linepulse.plans import serving
from linepulse.scratch import fresh_path, stage
from linepulse.sources import adapter, catalog, feed, snapshots
from linepulse.sources import keyed as keyed_tables
from linepulse.sources.adapter import AS_OF, NOW, SUPPLIED_LINES, profiles, status, table
from linepulse.streaming import flows
from linepulse.tables import (
    CUSTOMER_JOURNEYS,
    CUSTOMER_PROFILES,
    DISRUPTION_SUMMARY,
    LINE_STATUS,
    NOTIFICATION_TARGETS,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Splits the supplied status rows into an earlier and a later part.
MIDDLE = "2024-01-16 00:00:00"
# A day by which part of the bronze rows has reached its end.
PURGE_AT = "2026-01-15 00:00:00"
# Events of a file that the journeys stream reads; a batch of many has several files, which tasks read side by side.
LANDED_ROWS = 250_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def bronze_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows with all columns of their table."""
    rows = status(spark, sf_dir).withColumn(
        "_delete_at", plus_days(F.col("_inserted_at"), RETENTION_DAYS["operational"])
    )
    return catalog.with_raw(rows, [*journeys.STATUS_COLUMNS, "station_name", "_inserted_at", "_updated_at"])


def all_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journeys.customer_journeys(profiles(spark, sf_dir), status(spark, sf_dir), AS_OF)


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.disruption_summary(all_journeys(spark, sf_dir), AS_OF)


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.notification_targets(all_journeys(spark, sf_dir), AS_OF)


def new_schema(spark: SparkSession) -> tuple[str, str]:
    """Name and folder of a schema that this run alone uses."""
    return f"linepulse_{uuid.uuid4().hex}", fresh_path(spark, "schema")


# Sources and sinks


@query
def scan_static(spark, sf_dir):
    return profiles(spark, sf_dir)


@query
def scan_stream(spark, sf_dir):
    root = fresh_path(spark, "scan")
    events = flows.scan_stream(
        spark, adapter.glob_of(sf_dir, "events"), table(spark, sf_dir, "events").schema
    )
    rows = adapter.as_status(events).select(
        "row_id", "line_id", "station_name", "status_severity", "_updated_at"
    )
    rows.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(
        availableNow=True
    ).start(f"{root}/rows", format="parquet").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/rows")


@query
def flatten_status(spark, sf_dir):
    rows = status(spark, sf_dir)
    mapping = stage(adapter.station_lines(spark, sf_dir, rows), "station-lines")
    return feed.flatten_status(adapter.feed(rows), mapping)


@query
def records_to_bronze(spark, sf_dir):
    rows = bronze_status(spark, sf_dir)
    untyped = rows.select([F.col(c).cast("string") for c in rows.columns])
    damaged = F.when(F.col("row_id").cast("long") % 50 == 0, "n/a")
    untyped = untyped.withColumns(
        {
            "status_severity": F.coalesce(damaged, "status_severity"),
            "_updated_at": F.coalesce(damaged, "_updated_at"),
        }
    )
    return catalog.conform(untyped, LINE_STATUS)


@query
def keep_raw_payload(spark, sf_dir):
    columns = [*journeys.PROFILE_COLUMNS, "customer_notes"]
    return catalog.with_raw(profiles(spark, sf_dir).select(columns), columns)


@query
def stamp_platform_cols(spark, sf_dir):
    rows = profiles(spark, sf_dir).select("customer_id", moment(NOW).alias("run_ts"))
    return feed.stamp(rows, RETENTION_DAYS["profile"], at="run_ts").drop("run_ts")


@query
def create_table_idempotent(spark, sf_dir):
    schema, folder = new_schema(spark)
    name = catalog.ensure_table(spark, LINE_STATUS, schema, folder)
    catalog.append(bronze_status(spark, sf_dir), name, LINE_STATUS)
    catalog.ensure_table(spark, LINE_STATUS, schema, folder)
    return spark.table(name)


@query
def reconcile_properties(spark, sf_dir):
    schema, folder = new_schema(spark)
    name = catalog.ensure_table(spark, LINE_STATUS, schema, folder)
    catalog.append(bronze_status(spark, sf_dir), name, LINE_STATUS)
    catalog.set_properties(spark, name, {"platform.freshness_sla": "9d"})
    catalog.set_properties(spark, name, LINE_STATUS.properties)
    sla = (
        catalog.table_properties(spark, name)
        .filter(F.col("key") == "platform.freshness_sla")
        .select("value")
        .scalar()
    )
    return (
        spark.table(name)
        .groupBy("line_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("freshness_sla", sla)
    )


@query
def append_sink(spark, sf_dir):
    schema, folder = new_schema(spark)
    name = catalog.ensure_table(spark, LINE_STATUS, schema, folder)
    rows = bronze_status(spark, sf_dir)
    later = F.col("_updated_at") >= moment(MIDDLE)
    catalog.append(rows.filter(~later), name, LINE_STATUS)
    catalog.append(rows.filter(later), name, LINE_STATUS)
    return spark.table(name)


@query
def overwrite_sink(spark, sf_dir):
    schema, folder = new_schema(spark)
    name = catalog.ensure_table(spark, CUSTOMER_PROFILES, schema, folder)
    rows = profiles(spark, sf_dir)
    rows = catalog.with_raw(rows, [*journeys.PROFILE_COLUMNS, "customer_notes"]).withColumn(
        "_delete_at", plus_days(F.col("_inserted_at"), RETENTION_DAYS["profile"])
    )
    catalog.append(rows.withColumn("email", F.upper("email")), name, CUSTOMER_PROFILES)
    catalog.overwrite(rows, name, CUSTOMER_PROFILES)
    return spark.table(name)


@query
def snapshot_export(spark, sf_dir):
    path = fresh_path(spark, "snapshot")
    snapshots.export_snapshot(bronze_status(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def snapshot_reload(spark, sf_dir):
    path = fresh_path(spark, "snapshot")
    snapshots.export_snapshot(catalog.conform(bronze_status(spark, sf_dir), LINE_STATUS), path)
    schema, folder = new_schema(spark)
    name = catalog.ensure_table(spark, LINE_STATUS, schema, folder)
    snapshots.reload_snapshot(spark, path, name, NOW)
    snapshots.reload_snapshot(spark, path, name, NOW, quiet=True)
    return spark.table(name)


@query
def time_shift(spark, sf_dir):
    return snapshots.time_shift(bronze_status(spark, sf_dir), NOW)


@query
def reload_guard(spark, sf_dir):
    rows = status(spark, sf_dir)
    outcomes = []
    for mode, force, quiet in (("plain", False, False), ("quiet", False, True), ("force", True, False)):
        try:
            outcome = "load" if snapshots.may_reload(rows, force, quiet) else "skip"
        except snapshots.AlreadyLoaded:
            outcome = "error"
        outcomes.append(F.struct(F.lit(mode).alias("mode"), F.lit(outcome).alias("outcome")))
    return snapshots.count_rows(rows).select("rows", F.inline(F.array(*outcomes)))


# Projections, filters and predicates


@query
def filter_disrupted(spark, sf_dir):
    return journeys.disrupted(status(spark, sf_dir)).select(
        "row_id", "line_id", "station_name", "status_severity"
    )


@query
def project_journey(spark, sf_dir):
    latest = stage(
        journeys.latest_status(journeys.disrupted(status(spark, sf_dir))), "latest-status"
    )
    rows = journeys.join_profiles_status(profiles(spark, sf_dir), latest)
    return rows.select(
        *journeys.PROFILE_COLUMNS, *journeys.STATUS_COLUMNS, "_inserted_at", "_updated_at"
    )


@query
def project_notification(spark, sf_dir):
    return targets(spark, sf_dir).drop("_delete_at")


def _rule(spark, sf_dir, name):
    rule = journeys.profile_rules(AS_OF)[name]
    return quality.expect_drop(profiles(spark, sf_dir), {name: rule})


@query
def filter_not_null(spark, sf_dir):
    return _rule(spark, sf_dir, "home_station_not_null").select("customer_id", "home_station")


@query
def filter_email_valid(spark, sf_dir):
    return _rule(spark, sf_dir, "valid_email").select("customer_id", "email")


@query
def filter_dob_plausible(spark, sf_dir):
    return _rule(spark, sf_dir, "plausible_birth").select("customer_id", "date_of_birth")


@query
def filter_recent_days(spark, sf_dir):
    return journeys.recent_days(summary(spark, sf_dir), AS_OF).select(
        *gold.SUMMARY_KEYS, "affected_customers"
    )


@query
def filter_known_lines(spark, sf_dir):
    return journeys.known_lines(status(spark, sf_dir), SUPPLIED_LINES).select("row_id", "line_id")


# Joins


@query
def join_profiles_status(spark, sf_dir):
    """Customers with the latest disrupted row of each line at their station.

    Older rows of a line never reach the table behind the join, so they are left
    out before it; ``join_fanout`` counts what the whole histories would give.
    """
    latest = stage(
        journeys.latest_status(journeys.disrupted(status(spark, sf_dir))), "latest-status"
    )
    return journeys.join_profiles_status(profiles(spark, sf_dir), latest).select(
        "customer_id", "home_station", "line_id", "status_severity", "_inserted_at", "_updated_at",
        "_status_updated_at", "_status_row",
    )


@query
def join_fanout(spark, sf_dir):
    return journeys.join_fanout(
        profiles(spark, sf_dir), journeys.disrupted(status(spark, sf_dir))
    )


@query
def lookup_line_status(spark, sf_dir):
    """Each mapped station and line with the newest record of the line in the whole feed."""
    rows = status(spark, sf_dir)
    mapping = stage(adapter.station_lines(spark, sf_dir, rows), "station-lines")
    pairs = feed.station_pairs(mapping)
    newest = keyed.scd1(rows, ["line_id"], ["_updated_at", "row_id"])
    records = newest.withColumn("row", adapter.as_struct(newest)).select(
        "line_id", F.from_json(json_text(adapter.line_record()), LINE_RECORD).alias("record")
    )
    fields = line_fields(F.col("record"), F.col("line_id"))
    return pairs.join(records, "line_id", "left").select(
        "station_name", "line_id", *[c.alias(n) for n, c in fields.items()]
    )


@query
def latest_then_join(spark, sf_dir):
    return all_journeys(spark, sf_dir)


# Aggregates


@query
def disruption_summary(spark, sf_dir):
    return summary(spark, sf_dir)


def _measure(*columns):
    return lambda spark, sf_dir: summary(spark, sf_dir).select(*gold.SUMMARY_KEYS, *columns)


QUERIES["agg_count_nonnull"] = _measure("affected_customers")
QUERIES["agg_count_distinct"] = _measure("affected_stations")
QUERIES["agg_first"] = _measure("disruption_description")
QUERIES["agg_max"] = _measure("last_updated")
QUERIES["agg_min"] = _measure("_inserted_at", "_updated_at")


@query
def count_rows(spark, sf_dir):
    return snapshots.count_rows(status(spark, sf_dir))


# Serving


@query
def q_disruptions_by_line(spark, sf_dir):
    return serving.disruptions_by_line(summary(spark, sf_dir))


@query
def q_daily_customer_impact(spark, sf_dir):
    return serving.daily_customer_impact(summary(spark, sf_dir))


@query
def q_severity_distribution(spark, sf_dir):
    return serving.severity_distribution(summary(spark, sf_dir))


@query
def q_customers_to_alert(spark, sf_dir):
    return serving.customers_to_alert(targets(spark, sf_dir), keyed=True)


@query
def q_affected_stations(spark, sf_dir):
    return serving.affected_stations(targets(spark, sf_dir))


@query
def q_scorecard_30d(spark, sf_dir):
    return serving.scorecard(summary(spark, sf_dir), AS_OF)


@query
def q_notification_counter(spark, sf_dir):
    return serving.notification_counter(targets(spark, sf_dir))


@query
def w_events_by_line(spark, sf_dir):
    return serving.events_by_line(q_disruptions_by_line(spark, sf_dir))


@query
def w_daily_trend(spark, sf_dir):
    return serving.daily_trend(q_daily_customer_impact(spark, sf_dir))


@query
def w_severity_breakdown(spark, sf_dir):
    return serving.severity_breakdown(q_severity_distribution(spark, sf_dir))


QUERIES["sort_desc"] = q_severity_distribution
QUERIES["sort_asc_date"] = q_daily_customer_impact
QUERIES["top_k_stations"] = q_affected_stations


# Scalar functions


@query
def fn_age_years(spark, sf_dir):
    return profiles(spark, sf_dir).select(
        "customer_id", "date_of_birth", age_years(F.col("date_of_birth"), AS_OF).alias("age")
    )


@query
def fn_retention_stamp(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        retention_stamp(F.col("o_orderdate"), RETENTION_DAYS["alerting"]).alias("_delete_at"),
    )


@query
def fn_oldest_of(spark, sf_dir):
    noon = F.to_date("_updated_at").cast(TS) + F.expr("interval 12 hours")
    other = F.when(F.col("row_id") % 10 != 0, noon)
    return status(spark, sf_dir).select(
        "row_id", oldest_of(F.col("_updated_at"), other).alias("oldest")
    )


@query
def fn_to_date(spark, sf_dir):
    return status(spark, sf_dir).select(
        "row_id", F.to_date("_updated_at").alias("disruption_date")
    )


@query
def fn_cast(spark, sf_dir):
    """Text to date, number and timestamp; text that does not parse gives NULL."""
    day_text = F.concat(
        F.lit("2024-01-"), F.lpad((F.col("row_id") % 40).cast("string"), 2, "0")
    )
    severity_text = F.when(F.col("row_id") % 9 == 0, "none").otherwise(
        F.col("status_severity").cast("string")
    )
    return status(spark, sf_dir).select(
        "row_id",
        day_text.try_cast("date").alias("as_date"),
        severity_text.try_cast("int").alias("as_int"),
        F.concat(day_text, F.lit(" 10:30:00")).try_cast(TS).alias("as_timestamp"),
    )


@query
def fn_json_write(spark, sf_dir):
    record = F.struct(
        "line_id",
        F.when(F.col("row_id") % 5 != 0, F.col("disruption_reason")).alias("reason"),
        "status_severity",
        F.array("station_name").alias("stops"),
    )
    return status(spark, sf_dir).select("row_id", json_text(record).alias("record"))


@query
def fn_json_navigate(spark, sf_dir):
    """Each status row written as a feed record, then read back field by field."""
    rows = status(spark, sf_dir)
    text = rows.withColumn("row", adapter.as_struct(rows)).select(
        "row_id", "line_id", json_text(adapter.line_record()).alias("text")
    )
    parsed = text.withColumn("record", F.from_json("text", LINE_RECORD))
    fields = line_fields(F.col("record"), F.col("line_id"))
    return parsed.select("row_id", *[c.alias(n) for n, c in fields.items()])


@query
def fn_array_map(spark, sf_dir):
    common = F.when(F.col("row_id") % 3 != 0, F.concat(F.col("station_name"), F.lit(" Stop")))
    name = F.when(F.col("row_id") % 7 != 0, F.col("station_name"))
    first = F.struct(common.alias("commonName"), name.alias("name"))
    second = F.struct(
        F.lit(None).cast("string").alias("commonName"), F.col("line_name").alias("name")
    )
    return status(spark, sf_dir).select(
        "row_id", F.to_json(stop_names(F.array(first, second))).alias("stops")
    )


@query
def fn_rlike(spark, sf_dir):
    return profiles(spark, sf_dir).select(
        "customer_id", F.col("email").rlike(EMAIL_PATTERN).alias("valid")
    )


@query
def fn_in_list(spark, sf_dir):
    return status(spark, sf_dir).select(
        "row_id", F.col("line_id").isin(list(SUPPLIED_LINES)).alias("known")
    )


@query
def fn_interval_sub(spark, sf_dir):
    return status(spark, sf_dir).select(
        "row_id", recent(F.to_date("_updated_at"), "2024-02-14", RECENT_DAYS).alias("recent")
    )


@query
def fn_ts_add(spark, sf_dir):
    return status(spark, sf_dir).select(
        "row_id",
        plus_days(F.col("_inserted_at"), RETENTION_DAYS["operational"]).alias("fixed_days"),
        plus_days(F.col("_inserted_at"), (F.col("row_id") % 30).cast("int")).alias("own_days"),
    )


# Data quality


@query
def expect_warn(spark, sf_dir):
    """All summary rows, each with the number of rows that broke the rules."""
    checked, seen = quality.expect_warn(
        summary(spark, sf_dir), gold.summary_rules(SUPPLIED_LINES), f"warn-{uuid.uuid4().hex}"
    )
    rows = stage(checked, "checked")
    counts = seen.get
    return rows.select(
        *gold.SUMMARY_KEYS,
        "affected_customers",
        *[F.lit(counts[rule]).cast("long").alias(f"{rule}_failed") for rule in gold.summary_rules()],
    )


@query
def expect_drop(spark, sf_dir):
    return quality.expect_drop(profiles(spark, sf_dir), journeys.profile_rules(AS_OF)).select(
        journeys.PROFILE_COLUMNS
    )


@query
def expect_drop_reasons(spark, sf_dir):
    """The profiles that ``expect_drop`` drops, and why."""
    rules = journeys.profile_rules(AS_OF)
    marked, _ = quality.judged(profiles(spark, sf_dir), rules, f"reasons-{uuid.uuid4().hex}")
    rejected = quality.rejected_rows(marked, rules)
    return rejected.select("customer_id", F.array_join("broken_rules", ",").alias("broken_rules"))


@query
def dq_report(spark, sf_dir):
    return quality.dq_report(profiles(spark, sf_dir), journeys.profile_rules(AS_OF))


# Upserts and streams


@query
def scd1_upsert(spark, sf_dir):
    """Later rows first, then the earlier ones arrive: they must not win."""
    people, rows = profiles(spark, sf_dir), status(spark, sf_dir)
    later = F.col("_updated_at") >= moment(MIDDLE)
    target = journeys.journey_versions(people, rows.filter(later), AS_OF)
    late = journeys.journey_versions(people, rows.filter(~later), AS_OF)
    return journeys.table_rows(keyed.upsert(target, late, journeys.KEYS, journeys.SEQUENCE))


def _run_journeys(spark, sf_dir):
    root = fresh_path(spark, "journeys")
    landed, events = f"{root}/landed", table(spark, sf_dir, "events")
    # Shuffled files, three batches of them: late rows have to lose across batches.
    files = max(1, math.ceil(events.count() / 3 / LANDED_ROWS))
    events.repartition(3 * files, F.xxhash64("event_id")).write.parquet(landed)
    events = flows.scan_stream(spark, landed, events.schema, files_per_batch=files)
    flows.stream_journeys(
        adapter.as_status(events), lambda: profiles(spark, sf_dir), root, AS_OF
    ).awaitTermination()
    return root


@query
def stream_journeys(spark, sf_dir):
    return flows.current_journeys(spark, _run_journeys(spark, sf_dir))


@query
def stream_notifications(spark, sf_dir):
    root = fresh_path(spark, "targets")
    flows.stream_notifications(
        spark, _run_journeys(spark, sf_dir), root, AS_OF
    ).awaitTermination()
    return flows.current_targets(spark, root)


@query
def changed_rows_feed(spark, sf_dir):
    """What a batch of the later status rows changes in the journeys of the earlier ones."""
    people, rows = profiles(spark, sf_dir), status(spark, sf_dir)
    later = F.col("_updated_at") >= moment(MIDDLE)
    return keyed.batch_changes(
        journeys.journey_versions(people, rows.filter(~later), AS_OF),
        journeys.journey_versions(people, rows.filter(later), AS_OF),
        journeys.KEYS,
        journeys.SEQUENCE,
    ).select(
        "_change_type", "customer_id", "line_id", "status_severity", "disruption_reason",
        "_updated_at",
    )


# Masks and tags


def _masked(column, mask):
    return lambda spark, sf_dir: profiles(spark, sf_dir).select(
        "customer_id", mask(F.col(column)).alias(column)
    )


QUERIES["mask_name"] = _masked("full_name", masks.mask_name)
QUERIES["mask_email"] = _masked("email", masks.mask_email)
QUERIES["mask_dob"] = _masked("date_of_birth", masks.mask_birth)
QUERIES["mask_postcode"] = _masked("home_postcode", masks.mask_postcode)


@query
def mask_for_audience(spark, sf_dir):
    tagged = governance.tag_columns(all_journeys(spark, sf_dir), JOURNEY_TAGS)
    return governance.mask_for_audience(tagged, "standard-readers").select(
        journeys.PROFILE_COLUMNS + ["line_id"]
    )


@query
def tag_columns(spark, sf_dir):
    people = governance.tag_columns(all_journeys(spark, sf_dir), JOURNEY_TAGS)
    alerts = governance.tag_columns(targets(spark, sf_dir), TARGET_TAGS)
    return (
        governance.tag_coverage(people)
        .withColumn("table_name", F.lit(CUSTOMER_JOURNEYS.name))
        .unionByName(
            governance.tag_coverage(alerts).withColumn(
                "table_name", F.lit(NOTIFICATION_TARGETS.name)
            )
        )
    )


@query
def pii_scan(spark, sf_dir):
    people = governance.tag_columns(
        profiles(spark, sf_dir), {"email": JOURNEY_TAGS["email"]}
    )
    found = governance.pii_scan(
        people, ["email", "telephone_number", "home_postcode", "customer_notes"]
    )
    texts = [
        governance.pii_scan(table(spark, sf_dir, name).select(F.col("text").alias(f"{name}_text")),
                            [f"{name}_text"])
        for name in ("documents", "conversations")
    ]
    for part in texts:
        found = found.unionByName(part)
    return found


@query
def notes_explode(spark, sf_dir):
    return governance.explode_notes(
        profiles(spark, sf_dir).select("customer_id", "customer_notes")
    )


@query
def notes_own_pii(spark, sf_dir):
    return governance.notes_own_pii(profiles(spark, sf_dir))


# Retention, freshness and profiles over time


@query
def freshness_status(spark, sf_dir):
    silver = all_journeys(spark, sf_dir)
    tables = {
        LINE_STATUS: status(spark, sf_dir),
        CUSTOMER_PROFILES: profiles(spark, sf_dir),
        CUSTOMER_JOURNEYS: silver,
        DISRUPTION_SUMMARY: gold.disruption_summary(silver, AS_OF),
        NOTIFICATION_TARGETS: gold.notification_targets(silver, AS_OF),
    }
    return upkeep.freshness(
        {spec.name: (df, spec.freshness_sla) for spec, df in tables.items()},
        "2024-01-30 12:00:00",
    )


@query
def retention_purge(spark, sf_dir):
    return upkeep.kept(bronze_status(spark, sf_dir), PURGE_AT).select(
        "row_id", "line_id", "_inserted_at", "_delete_at"
    )


@query
def retention_by_purpose(spark, sf_dir):
    """Per table and day: the days its purpose allows, and when the day's rows end."""
    silver = all_journeys(spark, sf_dir)
    tables = {
        LINE_STATUS: status(spark, sf_dir),
        CUSTOMER_PROFILES: profiles(spark, sf_dir),
        CUSTOMER_JOURNEYS: silver,
    }
    parts = [
        df.groupBy(F.to_date("_inserted_at").alias("inserted_on"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.lit(spec.name).alias("table_name"),
            F.lit(spec.purpose).alias("purpose"),
            "inserted_on",
            "rows",
        )
        for spec, df in tables.items()
    ]
    days = retention_days(F.col("purpose"))
    return (
        parts[0].unionByName(parts[1]).unionByName(parts[2])
        .withColumn("days", days)
        .withColumn("ends_on", F.date_add("inserted_on", F.col("days")))
    )


@query
def profile_metrics(spark, sf_dir):
    """Every column of the journeys."""
    return observe.profile_metrics(
        all_journeys(spark, sf_dir), "_updated_at", CUSTOMER_JOURNEYS.column_names
    )


@query
def profile_metrics_summary(spark, sf_dir):
    """Every column of the summary."""
    return observe.profile_metrics(
        summary(spark, sf_dir), "disruption_date", DISRUPTION_SUMMARY.column_names
    )


@query
def drift_metrics(spark, sf_dir):
    return observe.drift_metrics(profile_metrics(spark, sf_dir))


@query
def profile_sketches(spark, sf_dir):
    """Every column of the journeys, per week from the sketches of its days, held against exact counts.

    Estimates themselves are no part of the result: a distinct count has to be within four standard
    errors of the exact one, and quantiles have to lie in order between the extremes.
    """
    rows = all_journeys(spark, sf_dir)
    names = CUSTOMER_JOURNEYS.column_names
    daily = sketches.profile_sketches(rows, "_updated_at", names)
    found = sketches.sketch_metrics(sketches.merge_windows(daily, "7 days"))
    exact = observe.profile_metrics(rows, "_updated_at", names, "7 days").select(
        "window_start", "column_name", F.col("distinct_values").alias("exact")
    )
    apart = F.abs(F.col("distinct_values") - F.col("exact"))
    low, *quantiles, high = [F.col("min_value").try_cast("double"), *map(F.col, sketches.QUANTILES), F.col("max_value").try_cast("double")]
    in_order = F.lit(True)
    for a, b in zip([low, *quantiles], [*quantiles, high], strict=True):
        in_order = in_order & (a <= b)
    return found.join(exact, ["window_start", "column_name"]).select(
        "window_start", "column_name", "rows", "nulls", "min_value", "max_value", "mean_value",
        (apart <= 4 * 1.04 / 2 ** (sketches.LG / 2) * F.col("exact")).alias("distinct_within_error"),
        F.when(F.col("p50").isNull(), F.lit(True)).otherwise(in_order).alias("quantiles_in_order"),
    )


@query
def drift_distribution(spark, sf_dir):
    """Shape of the journeys' severities and ages, and shares of lines, severities and stations, day against day."""
    return drift.distribution_drift(
        all_journeys(spark, sf_dir), "_updated_at", ["status_severity", "age"],
        ["line_id", "status_severity_description", "home_station"],
    )


@query
def summary_by_changes(spark, sf_dir):
    """The summary after the later status rows, from the counts of the earlier ones and signed changes."""
    people, rows = profiles(spark, sf_dir), status(spark, sf_dir)
    later = F.col("_updated_at") >= moment(MIDDLE)
    before = stage(journeys.customer_journeys(people, rows.filter(~later), AS_OF), "journeys")
    n = CUSTOMER_JOURNEYS.buckets
    old, new = (
        catalog.with_bucket(df, journeys.KEYS, n)
        for df in (before, journeys.customer_journeys(people, rows.filter(later), AS_OF))
    )
    pairs = stage(keyed_tables.image_pairs(old, new, journeys.KEYS, ["_updated_at"]), "pairs")
    images = counts.signed(pairs.drop(catalog.BUCKET))
    gone = before.join(pairs.where("_old IS NOT NULL").select("_old.customer_id", "_old.line_id"), journeys.KEYS, "left_anti")
    after = gone.select(before.columns).unionByName(pairs.select("_new.*"))
    with counts.counts_after(counts.station_counts(before), images, after) as kept:
        return stage(counts.summary_of_counts(kept, AS_OF), "summary")
