"""Keeping the history of a table outside the catalog, and bringing it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.fixed import RETENTION_DAYS
from linepulse.functions.temporal import moment, plus_days
from linepulse.sources.catalog import append
from linepulse.tables import LINE_STATUS, TableSpec


class AlreadyLoaded(RuntimeError):
    """The target of a reload has rows."""


def export_snapshot(df: DataFrame, path: str) -> None:
    """Save every row, types kept."""
    df.write.mode("errorifexists").parquet(path)


def time_shift(
    df: DataFrame,
    now: dt.datetime | str | Column,
    days: int = RETENTION_DAYS["operational"],
) -> DataFrame:
    """Move all rows by one offset, so that the newest ``_inserted_at`` falls on ``now``.

    Gaps between rows stay; ``_delete_at`` follows from the moved insert time.
    """
    offset = moment(now) - df.agg(F.max("_inserted_at")).scalar()
    moved = df.withColumns(
        {
            "_inserted_at": F.col("_inserted_at") + offset,
            "_updated_at": F.col("_updated_at") + offset,
        }
    )
    return moved.withColumn("_delete_at", plus_days(F.col("_inserted_at"), days))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def may_reload(target: DataFrame, force: bool = False, quiet: bool = False) -> bool:
    """Whether to load into ``target``.

    A target with rows is an error, unless ``force`` loads anyway or ``quiet``
    (for automated runs) leaves it as it is.
    """
    if force or target.isEmpty():
        return True
    if quiet:
        return False
    raise AlreadyLoaded("the target has rows; reload with force=True to add to them")


def reload_snapshot(
    spark: SparkSession,
    path: str,
    table: str,
    now: dt.datetime | str,
    spec: TableSpec = LINE_STATUS,
    force: bool = False,
    quiet: bool = False,
) -> bool:
    """Append the snapshot to ``table``, moved to ``now``; False when it was left alone."""
    if not may_reload(spark.table(table), force, quiet):
        return False
    append(time_shift(spark.read.parquet(path), now), table, spec)
    return True
