"""Upserts into bucketed tables: a batch costs what it changes, not what the table holds.

The buckets of a batch's keys are read and compared with it. What really changes is written aside, as
the row before and the row after; only buckets with a change are rewritten. The change is noted on the
table before anything is replaced, so a job that fails later goes on with the same change: whatever
follows from it downstream follows once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.operators.upsert import scd1
from linepulse.scratch import remove, staged
from linepulse.sources.catalog import (
    BUCKET,
    buckets_of,
    conform,
    location_of,
    numbers,
    replace_buckets,
    seen_by,
    set_properties,
    table_properties,
    with_bucket,
)
from linepulse.tables import TableSpec

#: Property of a table that names the change under way; empty when there is none.
PENDING = "platform.pending_change"


def _match(keys: Sequence[str], left: str, right: str) -> Column:
    same = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, same, F.col(f"{left}.{BUCKET}") == F.col(f"{right}.{BUCKET}"))


def image_pairs(target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """``(bucket, _old, _new)`` of the keys that ``batch`` inserts or changes; ``_old`` is null for new keys.

    Both sides carry their bucket and have each key once. A row that is older than the target's, by
    ``sequence_by``, changes nothing, nor does an equal one; one that is equally old wins.
    """
    columns = [c for c in batch.columns if c != BUCKET]
    old, new = (
        df.select(BUCKET, *keys, F.struct(*columns).alias("row")).alias(side) for side, df in (("o", target), ("n", batch))
    )
    both = new.join(old, _match(keys, "n", "o"), "left")
    order = [F.struct(*[F.col(f"{side}.row.{c}") for c in sequence_by]) for side in ("n", "o")]
    changed = F.col("o.row").isNull() | ((order[0] >= order[1]) & (F.col("n.row") != F.col("o.row")))
    # Structs with nulls inside compare like values; only a missing row is null.
    return both.where(changed).select(F.col(f"n.{BUCKET}"), F.col("o.row").alias("_old"), F.col("n.row").alias("_new"))


def pending(spark: SparkSession, table: str) -> str:
    """The change under way of a table, or an empty text."""
    found = {r.key: r.value for r in table_properties(spark, table).collect()}
    return found.get(PENDING, "")


def read_change(spark: SparkSession, table: str, change: str) -> DataFrame:
    """``(bucket, _old, _new)`` of a change."""
    return spark.read.parquet(_change_path(spark, table, change))


def _change_path(spark: SparkSession, table: str, change: str) -> str:
    return f"{location_of(spark, table)}/changes-{change}"


def prepare(batch: DataFrame, table: str, spec: TableSpec, sequence_by: Sequence[str] = ("_updated_at",)) -> str:
    """Write what ``batch`` changes beside the table and note it; the change's name, or an empty text if none.

    ``batch`` may hold a key several times; its newest row counts, equally new ones by their content.
    """
    spark = batch.sparkSession
    if pending(spark, table):
        raise ValueError(f"{table} has a change under way")
    rows = with_bucket(conform(batch, spec), spec.keys, buckets_of(spark, table))
    tie = F.xxhash64(*[c for c in spec.column_names if c not in spec.keys])
    rows = scd1(rows.withColumn("_tie", tie), spec.keys, [*sequence_by, "_tie"]).drop("_tie")
    change = uuid.uuid4().hex
    path = _change_path(spark, table, change)
    with staged(rows, "batch") as new:
        target = spark.table(table).where(F.col(BUCKET).isin(numbers(new)))
        image_pairs(target, new, spec.keys, sequence_by).write.parquet(path)
    if spark.read.parquet(path).isEmpty():
        remove(spark, path)
        return ""
    set_properties(spark, table, {PENDING: change})
    return change


def apply(spark: SparkSession, table: str, spec: TableSpec, change: str) -> set[int]:
    """Put a change into its table, and return the buckets it touches; done buckets are passed over."""
    pairs = read_change(spark, table, change)
    touched = set(numbers(pairs))
    left = sorted(touched - seen_by(spark, table, change))
    if left:
        kept = spark.table(table).where(F.col(BUCKET).isin(left)).alias("o")
        new = pairs.select(BUCKET, "_new.*")
        kept = kept.join(new.select(BUCKET, *spec.keys).alias("n"), _match(spec.keys, "o", "n"), "left_anti")
        replace_buckets(kept.unionByName(new), table, left, change, spec.cluster_by)
    return touched


def finish(spark: SparkSession, table: str, change: str) -> None:
    """The change and all that follows from it is done."""
    set_properties(spark, table, {PENDING: ""})
    remove(spark, _change_path(spark, table, change))


def upsert_table(batch: DataFrame, table: str, spec: TableSpec, sequence_by: Sequence[str] = ("_updated_at",)) -> set[int]:
    """Update or insert the rows of ``batch`` by key; the buckets that were rewritten.

    A change that an earlier call left half done is completed first.
    """
    spark = batch.sparkSession
    if change := pending(spark, table):
        apply(spark, table, spec, change)
        finish(spark, table, change)
    change = prepare(batch, table, spec, sequence_by)
    if not change:
        return set()
    touched = apply(spark, table, spec, change)
    finish(spark, table, change)
    return touched


def sync(rows: DataFrame, table: str, spec: TableSpec) -> set[int]:
    """Make a table hold exactly ``rows``, and rewrite only the buckets that differ; those."""
    spark = rows.sparkSession
    laid = with_bucket(conform(rows, spec), spec.keys, buckets_of(spark, table))
    with staged(laid, "rows") as new:
        old = spark.table(table).select(new.columns)
        touched = set(numbers(new.exceptAll(old).unionByName(old.exceptAll(new))))
        if touched:
            replace_buckets(new, table, touched, uuid.uuid4().hex, spec.cluster_by)
    return touched
