"""Status rows and profiles as customer journeys: the latest disruption per customer and line."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.fixed import (
    EARLIEST_BIRTH,
    EMAIL_PATTERN,
    GOOD_SERVICE,
    KNOWN_LINE_IDS,
    RECENT_DAYS,
    RETENTION_DAYS,
)
from linepulse.functions.temporal import age_years, day, oldest_of, recent, retention_stamp
from linepulse.operators.quality import Rules, expect_drop
from linepulse.operators.upsert import scd1
from linepulse.scratch import stage, staged
from linepulse.tables import CUSTOMER_JOURNEYS

KEYS = ["customer_id", "line_id"]

# What orders the versions of a journey: the journey's own time, then the time
# and the row of the status behind it. Profile time often caps the first.
SEQUENCE = ["_updated_at", "_status_updated_at", "_status_row"]

PROFILE_COLUMNS = [
    "customer_id", "full_name", "email", "date_of_birth", "telephone_number",
    "home_postcode", "card_id", "home_station",
]
STATUS_COLUMNS = [
    "line_id", "line_name", "status_severity", "status_severity_description",
    "disruption_reason", "disruption_description", "affected_stops_json",
]

# The status side is broadcast up to this size, measured on its rows.
BROADCAST_BYTES = 256 * 1024 * 1024
# Timestamps, numbers and overhead of a row, next to its text.
ROW_BYTES = 128
# Customers of one station that a task of the shuffled join takes.
CUSTOMERS_A_TASK = 1_000_000
# About how many bytes of joined rows a task of the broadcast join makes.
JOINED_BYTES = 64 * 1024 * 1024


def disrupted(status: DataFrame) -> DataFrame:
    """Status rows below good service; an unknown status is one, a missing severity is not."""
    return status.filter(F.col("status_severity") < GOOD_SERVICE)


def known_lines(df: DataFrame, line_ids: Sequence[str] = KNOWN_LINE_IDS) -> DataFrame:
    return df.filter(F.col("line_id").isin(list(line_ids)))


def recent_days(df: DataFrame, as_of: dt.date | str, days: int = RECENT_DAYS) -> DataFrame:
    return df.filter(recent(F.col("disruption_date"), as_of, days))


def profile_rules(as_of: dt.date | str) -> Rules:
    """What a profile needs before its customer gets journeys."""
    birth = F.col("date_of_birth")
    return {
        "home_station_not_null": F.col("home_station").isNotNull(),
        "valid_email": F.col("email").rlike(EMAIL_PATTERN),
        "plausible_birth": (birth < day(as_of)) & (birth > day(EARLIEST_BIRTH)),
    }


def with_row_id(status: DataFrame) -> DataFrame:
    """Give status rows without a ``row_id`` one made of their content."""
    if "row_id" in status.columns:
        return status
    return status.withColumn("row_id", F.xxhash64(*STATUS_COLUMNS, "_inserted_at"))


def latest_status(status: DataFrame) -> DataFrame:
    """The latest row per station and line, with the columns that journeys are made of.

    The record as received is the widest column by far; it stays in the scan.
    """
    rows = with_row_id(status).select(
        "row_id", "station_name", *STATUS_COLUMNS, "_inserted_at", "_updated_at"
    )
    return scd1(rows, ["station_name", "line_id"], ["_updated_at", "row_id"])


def _size(df: DataFrame) -> Column:
    """About how large a row of ``df`` is in memory."""
    row = F.lit(ROW_BYTES)
    for c in (c for c, kind in df.dtypes if kind == "string"):
        row = row + F.coalesce(F.octet_length(c), F.lit(0))
    return row


def _row_bytes(df: DataFrame) -> int:
    """About how large the rows of ``df`` are in memory; an exact sum over all of them."""
    return df.agg(F.sum(_size(df))).first()[0] or 0


def _joined_bytes(profiles: DataFrame, status: DataFrame) -> float:
    """About how large the rows of the join are; both sides are summed per station before they meet."""
    people = profiles.groupBy("home_station").agg(F.count(F.lit(1)).alias("customers"), F.sum(_size(profiles)).alias("own"))
    reports = status.groupBy("station_name").agg(F.count(F.lit(1)).alias("reports"), F.sum(_size(status)).alias("bytes"))
    pairs = people.join(reports, people.home_station == reports.station_name)
    size = F.col("customers").cast("double") * F.col("bytes") + F.col("own").cast("double") * F.col("reports")
    return pairs.agg(F.sum(size)).first()[0] or 0.0


def dealt(profiles: DataFrame, status: DataFrame) -> DataFrame:
    """``profiles`` in as many parts as the rows of the broadcast join ask for.

    A file of profiles is small and few tasks read it, but each row becomes one per line of its station.
    """
    parts = math.ceil(_joined_bytes(profiles, status) / JOINED_BYTES)
    return profiles.repartition(parts, *profiles.columns) if parts > 1 else profiles


def station_parts(profiles: DataFrame, customers: int) -> DataFrame:
    """``(station, parts)`` of the stations with more than so many customers, as many parts as they need.

    There are fewer such stations than the customers divided by that number.
    """
    counts = profiles.groupBy(F.col("home_station").alias("station")).agg(F.count(F.lit(1)).alias("n"))
    heavy = counts.where((F.col("n") > customers) & F.col("station").isNotNull())
    return heavy.select("station", F.ceil(F.col("n") / customers).cast("int").alias("parts"))


def join_split(profiles: DataFrame, status: DataFrame, customers: int = CUSTOMERS_A_TASK) -> DataFrame:
    """The join by shuffle: a station with more than ``customers`` is dealt out in parts of that size.

    Only the status rows of such a station are repeated, once per part; other stations are one part.
    """
    parts = stage(station_parts(profiles, customers), "station-parts")
    # Fewer rows than customers / CUSTOMERS_A_TASK: a thousand for a thousand million.
    few = F.broadcast(parts)
    part = F.pmod(F.xxhash64("customer_id"), F.coalesce("parts", F.lit(1))).cast("int")
    split = profiles.join(few, F.col("home_station") == F.col("station"), "left").withColumn("part", part)
    last = F.coalesce(F.col("parts"), F.lit(1)) - 1
    repeated = status.join(few, F.col("station_name") == F.col("station"), "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), last))
    )
    return split.drop("station", "parts").alias("p").join(
        repeated.drop("station", "parts").alias("s"),
        (F.col("p.home_station") == F.col("s.station_name")) & (F.col("p.part") == F.col("s.part")),
    )


def join_profiles_status(profiles: DataFrame, status: DataFrame) -> DataFrame:
    """Every customer of a station with every status row of that station.

    Pass status rows reduced by ``latest_status`` and staged: the result is then
    one row per customer and line, and measuring the status side is cheap. That
    side is broadcast up to ``BROADCAST_BYTES``, and the profiles are ``dealt``. Beyond that the join
    shuffles, see ``join_split``.
    """
    status = with_row_id(status)
    profiles = profiles.select(*PROFILE_COLUMNS, "_inserted_at", "_updated_at")
    if _row_bytes(status) <= BROADCAST_BYTES:
        on_station = F.col("p.home_station") == F.col("s.station_name")
        joined = dealt(profiles, status).alias("p").join(F.broadcast(status.alias("s")), on_station)
    else:
        joined = join_split(profiles, status)
    return joined.select(
        *[F.col(f"p.{c}") for c in PROFILE_COLUMNS],
        *[F.col(f"s.{c}") for c in STATUS_COLUMNS],
        oldest_of(F.col("p._inserted_at"), F.col("s._inserted_at")).alias("_inserted_at"),
        oldest_of(F.col("p._updated_at"), F.col("s._updated_at")).alias("_updated_at"),
        F.col("s._updated_at").alias("_status_updated_at"),
        F.col("s.row_id").alias("_status_row"),
    )


def journey_versions(profiles: DataFrame, status: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Journeys of the given status rows, with the columns that order their versions.

    The rules are applied to profiles, once per customer. The latest row per
    station and line is taken before the join: for one customer the profile's
    time is constant, so the status row that wins there wins after the join too.
    """
    return _versions(profiles, stage(latest_status(disrupted(status)), "latest-status"), as_of)


@contextmanager
def journey_batch(profiles: DataFrame, status: DataFrame, as_of: dt.date | str) -> Iterator[DataFrame]:
    """``journey_versions`` for a job that ends inside the block, which leaves nothing behind."""
    with staged(latest_status(disrupted(status)), "latest-status") as latest:
        yield _versions(profiles, latest, as_of)


def _versions(profiles: DataFrame, latest: DataFrame, as_of: dt.date | str) -> DataFrame:
    good = expect_drop(profiles, profile_rules(as_of))
    return join_profiles_status(good, latest).withColumns(
        {
            "age": age_years(F.col("date_of_birth"), as_of),
            "_delete_at": retention_stamp(as_of, RETENTION_DAYS["alerting"]),
        }
    )


def table_rows(versions: DataFrame) -> DataFrame:
    """Journeys in the shape of their table."""
    return versions.select(CUSTOMER_JOURNEYS.column_names)


def customer_journeys(
    profiles: DataFrame, status: DataFrame, as_of: dt.date | str, unique_profiles: bool = True
) -> DataFrame:
    """The latest disruption per customer and line, over all of ``status``.

    Needs ``_updated_at`` in every status row. With one profile per customer the
    join already yields one row per key; otherwise pass ``unique_profiles=False``.
    """
    versions = journey_versions(profiles, status, as_of)
    if not unique_profiles:
        versions = scd1(versions, KEYS, SEQUENCE)
    return table_rows(versions)


def join_fanout(profiles: DataFrame, status: DataFrame) -> DataFrame:
    """How many rows the join of whole histories would have, per station and line.

    Both sides are counted before they meet, so no pair is ever produced.
    """
    customers = profiles.groupBy("home_station").agg(F.count(F.lit(1)).alias("customers"))
    reports = status.groupBy("station_name", "line_id").agg(F.count(F.lit(1)).alias("reports"))
    return reports.join(customers, reports.station_name == customers.home_station).select(
        "station_name", "line_id", (F.col("customers") * F.col("reports")).alias("pairs")
    )
