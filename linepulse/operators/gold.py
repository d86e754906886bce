"""Gold tables from journeys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.fixed import KNOWN_LINE_IDS, RETENTION_DAYS
from linepulse.functions.temporal import retention_stamp
from linepulse.operators.quality import Rules
from linepulse.tables import DISRUPTION_SUMMARY, NOTIFICATION_TARGETS

SUMMARY_KEYS = ["line_id", "line_name", "disruption_date", "status_severity_description"]


def disruption_summary(journeys: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Disruptions by line, day and severity.

    A description belongs to a station's status, not to a customer, so the first
    step groups by it too: hash aggregation of fixed-width values shrinks the
    journeys within each task, and only the few rows left need string handling.
    Timestamps take the oldest row of the group; the description is that of the
    newest, ties by station and text.
    """
    by_station = (
        journeys.withColumn("disruption_date", F.to_date("_updated_at"))
        .groupBy(*SUMMARY_KEYS, "home_station", "disruption_description")
        .agg(
            F.count("customer_id").alias("customers"),
            F.max("_updated_at").alias("newest"),
            F.min("_inserted_at").alias("inserted"),
            F.min("_updated_at").alias("updated"),
        )
    )
    return summary_of_stations(by_station, as_of)


def summary_of_stations(by_station: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The summary of rows per group, station and detail."""
    return (
        by_station.groupBy(*SUMMARY_KEYS)
        .agg(
            F.sum("customers").alias("affected_customers"),
            F.count_distinct("home_station").alias("affected_stations"),
            F.max_by(
                "disruption_description",
                F.struct("newest", "home_station", "disruption_description"),
            ).alias("disruption_description"),
            F.max("newest").alias("last_updated"),
            F.min("inserted").alias("_inserted_at"),
            F.min("updated").alias("_updated_at"),
        )
        .withColumn("_delete_at", retention_stamp(as_of, RETENTION_DAYS["operational"]))
        .select(DISRUPTION_SUMMARY.column_names)
    )


def summary_rules(line_ids: Sequence[str] = KNOWN_LINE_IDS) -> Rules:
    return {
        "disruption_date_not_null": F.col("disruption_date").isNotNull(),
        "valid_line_id": F.col("line_id").isin(list(line_ids)),
    }


def notification_targets(
    journeys: DataFrame, as_of: dt.date | str, extra: Sequence[str] = ()
) -> DataFrame:
    """Journeys without what alerting does not need, kept for the time alerting needs.

    ``extra`` names columns to carry along, such as those that order versions.
    """
    narrow = journeys.withColumn(
        "_delete_at", retention_stamp(as_of, RETENTION_DAYS["alerting"])
    )
    return narrow.select(*NOTIFICATION_TARGETS.column_names, *extra)
