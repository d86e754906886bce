"""Retention and freshness of tables.

The described behaviour is the only source for the purge and for the status.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.functions.temporal import moment, sla_interval
from linepulse.sources.catalog import buckets_of, numbers, overwrite, replace_buckets
from linepulse.tables import TableSpec


def kept(df: DataFrame, now: dt.datetime | str | Column) -> DataFrame:
    """Rows that stay after a purge; a row without an end is kept."""
    end = F.col("_delete_at")
    return df.filter(end.isNull() | (end > moment(now)))


def expired(df: DataFrame, now: dt.datetime | str | Column) -> DataFrame:
    """Rows that a purge removes: those whose end has come."""
    return df.filter(F.col("_delete_at") <= moment(now))


def purge(spark: SparkSession, table: str, spec: TableSpec, now: dt.datetime | str) -> None:
    """Remove expired rows from a table; of a bucketed one only buckets that hold such rows are rewritten."""
    rows = spark.table(table)
    if not buckets_of(spark, table):
        overwrite(kept(rows, now), table, spec)
    elif touched := numbers(expired(rows, now)):
        replace_buckets(kept(rows, now), table, touched, uuid.uuid4().hex, spec.cluster_by)


def freshness(
    tables: Mapping[str, tuple[DataFrame, str]], now: dt.datetime | str | Column
) -> DataFrame:
    """One row per table: its newest ``_updated_at`` against its agreement text.

    A table without rows, or with an agreement that does not parse, is stale.
    """
    newest = [
        df.agg(F.max("_updated_at").alias("newest")).select(
            F.lit(name).alias("table_name"), F.lit(sla).alias("sla"), "newest"
        )
        for name, (df, sla) in tables.items()
    ]
    in_time = moment(now) - F.col("newest") <= sla_interval(F.col("sla"))
    return reduce(DataFrame.unionByName, newest).withColumn(
        "status", F.when(in_time, "fresh").otherwise("stale")
    )
