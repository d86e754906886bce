"""The dashboard's queries on gold. Ties in an order are broken by the group's own key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.fixed import RECENT_DAYS, TOP_STATIONS
from linepulse.operators.journeys import recent_days


def disruptions_by_line(summary: DataFrame) -> DataFrame:
    """Affected customers and summary rows per line.

    A customer counts once per disrupted line, and an event is one summary row.
    """
    return (
        summary.groupBy("line_name")
        .agg(
            F.sum("affected_customers").alias("total_affected_customers"),
            F.count(F.lit(1)).alias("disruption_events"),
        )
        .orderBy(F.desc("total_affected_customers"), "line_name")
    )


def daily_customer_impact(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("disruption_date")
        .agg(
            F.sum("affected_customers").alias("affected_customers"),
            F.count_distinct("line_id").alias("lines_disrupted"),
        )
        .orderBy("disruption_date")
    )


def severity_distribution(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("status_severity_description")
        .agg(F.sum("affected_customers").alias("affected_customers"))
        .orderBy(F.desc("affected_customers"), "status_severity_description")
    )


def customers_to_alert(targets: DataFrame, keyed: bool = False) -> DataFrame:
    """Customers per line and reason.

    ``keyed`` says that ``targets`` has one row per customer and line, as its
    table does: then rows are customers and no distinct count is needed.
    """
    customers = F.count("customer_id") if keyed else F.count_distinct("customer_id")
    return (
        targets.groupBy("line_name", "line_id", "disruption_reason")
        .agg(customers.alias("customers_to_alert"))
        .orderBy(F.desc("customers_to_alert"), "line_id", "line_name", "disruption_reason")
    )


def affected_stations(targets: DataFrame, top: int = TOP_STATIONS) -> DataFrame:
    return (
        targets.groupBy("home_station")
        .agg(
            F.count_distinct("customer_id").alias("affected_customers"),
            F.count_distinct("line_id").alias("disrupted_lines"),
        )
        .orderBy(F.desc("affected_customers"), "home_station")
        .limit(top)
    )


def scorecard(summary: DataFrame, as_of: dt.date | str, days: int = RECENT_DAYS) -> DataFrame:
    return recent_days(summary, as_of, days).agg(
        F.count(F.lit(1)).alias("total_disruption_events"),
        F.sum("affected_customers").alias("total_affected_customers"),
        F.count_distinct("line_id").alias("distinct_lines_disrupted"),
    )


def notification_counter(targets: DataFrame) -> DataFrame:
    return targets.agg(F.count_distinct("customer_id").alias("customers_to_notify"))


def events_by_line(by_line: DataFrame) -> DataFrame:
    """The bars over ``disruptions_by_line``."""
    return (
        by_line.groupBy("line_name")
        .agg(F.sum("disruption_events").alias("disruption_events"))
        .orderBy(F.desc("disruption_events"), "line_name")
    )


def daily_trend(daily: DataFrame) -> DataFrame:
    """The lines over ``daily_customer_impact``."""
    return (
        daily.groupBy("disruption_date")
        .agg(
            F.sum("affected_customers").alias("affected_customers"),
            F.sum("lines_disrupted").alias("lines_disrupted"),
        )
        .orderBy("disruption_date")
    )


def severity_breakdown(distribution: DataFrame) -> DataFrame:
    """The bars over ``severity_distribution``."""
    return (
        distribution.groupBy("status_severity_description")
        .agg(F.sum("affected_customers").alias("affected_customers"))
        .orderBy(F.desc("affected_customers"), "status_severity_description")
    )
