"""The two streams: status to journeys, and journeys to notification targets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from linepulse.fixed import JOURNEY_TAGS, TARGET_TAGS, TS
from linepulse.operators.gold import notification_targets
from linepulse.operators.governance import tag_columns
from linepulse.operators.journeys import KEYS, SEQUENCE, journey_batch, table_rows
from linepulse.operators.upkeep import kept
from linepulse.operators.upsert import scd1
from linepulse.sources.catalog import ensure_table, overwrite, rows_of
from linepulse.streaming.changelog import (
    current_rows,
    fold,
    open_log,
    purge,
    stream_log,
    upsert_stream,
)
from linepulse.tables import CUSTOMER_JOURNEYS, NOTIFICATION_TARGETS, TableSpec

FILES_PER_BATCH = 1000


def versions_schema(spec: TableSpec) -> StructType:
    """The table's columns and those that order its versions."""
    schema = StructType()
    for name, kind, _ in spec.columns:
        schema = schema.add(name, kind)
    return schema.add("_status_updated_at", TS).add("_status_row", "long")


JOURNEYS = versions_schema(CUSTOMER_JOURNEYS)
TARGETS = versions_schema(NOTIFICATION_TARGETS)


def scan_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """A folder of Parquet files, or files matching a glob, as an append stream."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def stream_journeys(
    status: DataFrame,
    profiles: Callable[[], DataFrame],
    root: str,
    as_of: dt.date | str,
) -> StreamingQuery:
    """Upsert the journeys of each batch of status rows; profiles are read anew each time."""

    @contextmanager
    def rows_of(batch: DataFrame) -> Iterator[DataFrame]:
        with journey_batch(profiles(), batch, as_of) as rows:
            yield rows.select(JOURNEYS.names)

    return upsert_stream(status, root, rows_of)


def stream_notifications(
    spark: SparkSession, journeys_root: str, root: str, as_of: dt.date | str
) -> StreamingQuery:
    """Upsert notification targets from the rows that the journeys stream upserted.

    A batch here may span several of that stream, so it is reduced to one row per key.
    """
    order = ["_status_updated_at", "_status_row"]

    @contextmanager
    def rows_of(batch: DataFrame) -> Iterator[DataFrame]:
        narrow = notification_targets(batch, as_of, extra=order).select(TARGETS.names)
        # Keys repeat only as often as there are batches: nothing to drop, or sort, before the shuffle.
        yield scd1(narrow.repartition(*KEYS), KEYS, SEQUENCE)

    open_log(spark, journeys_root)
    return upsert_stream(stream_log(spark, journeys_root, JOURNEYS), root, rows_of, journeys_root)


def current_journeys(spark: SparkSession, root: str) -> DataFrame:
    return table_rows(current_rows(spark, root, JOURNEYS, KEYS, SEQUENCE))


def current_targets(spark: SparkSession, root: str) -> DataFrame:
    rows = current_rows(spark, root, TARGETS, KEYS, SEQUENCE)
    return rows.select(NOTIFICATION_TARGETS.column_names)


def publish_journeys(
    spark: SparkSession, root: str, schema: str, location: str | None = None
) -> DataFrame:
    """The current journeys as their catalog table, tagged, so masks, purge and freshness reach them."""
    return _publish(current_journeys(spark, root), CUSTOMER_JOURNEYS, JOURNEY_TAGS, schema, location)


def publish_targets(
    spark: SparkSession, root: str, schema: str, location: str | None = None
) -> DataFrame:
    return _publish(current_targets(spark, root), NOTIFICATION_TARGETS, TARGET_TAGS, schema, location)


def _publish(
    rows: DataFrame, spec: TableSpec, tags: Mapping[str, str], schema: str, location: str | None
) -> DataFrame:
    spark = rows.sparkSession
    table = ensure_table(spark, spec, schema, location)
    overwrite(tag_columns(rows, tags), table, spec)
    return rows_of(spark, table)


def purge_journeys(spark: SparkSession, root: str, now: dt.datetime | str) -> None:
    """Remove expired journeys from log and state; see ``changelog.purge``."""
    purge(spark, root, JOURNEYS, KEYS, SEQUENCE, lambda rows: kept(rows, now))


def purge_targets(spark: SparkSession, root: str, now: dt.datetime | str) -> None:
    purge(spark, root, TARGETS, KEYS, SEQUENCE, lambda rows: kept(rows, now))


def fold_journeys(spark: SparkSession, root: str) -> int:
    return fold(spark, root, JOURNEYS, KEYS, SEQUENCE)


def fold_targets(spark: SparkSession, root: str) -> int:
    return fold(spark, root, TARGETS, KEYS, SEQUENCE)
