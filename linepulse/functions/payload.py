"""Reading and writing the JSON of the status feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linepulse.fixed import UNKNOWN_DESCRIPTION, UNKNOWN_SEVERITY

# Severity is read as text because feeds send it as a number or as a string.
LINE_RECORD = """
    id string, name string,
    lineStatuses array<struct<
        statusSeverity: string, statusSeverityDescription: string, reason: string,
        disruption: struct<
            description: string,
            affectedStops: array<struct<commonName: string, name: string>>>>>
"""


def json_text(value: Column) -> Column:
    """``value`` as JSON; absent fields are written as null."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def stop_names(stops: Column) -> Column:
    """The name of each stop: its common name, else its name, else empty."""
    return F.transform(stops, lambda s: F.coalesce(s["commonName"], s["name"], F.lit("")))


def line_fields(record: Column, line_id: Column) -> dict[str, Column]:
    """The status columns of one parsed line record; only its first status counts.

    A missing record, status or field gives the defaults of an unknown line.
    """
    status = F.get(record["lineStatuses"], F.lit(0))
    disruption = status["disruption"]
    stops = F.coalesce(stop_names(disruption["affectedStops"]), F.array().cast("array<string>"))
    return {
        "line_name": F.coalesce(record["name"], line_id),
        "status_severity": F.coalesce(
            status["statusSeverity"].try_cast("int"), F.lit(UNKNOWN_SEVERITY)
        ),
        "status_severity_description": F.coalesce(
            status["statusSeverityDescription"], F.lit(UNKNOWN_DESCRIPTION)
        ),
        "disruption_reason": F.coalesce(status["reason"], F.lit("")),
        "disruption_description": F.coalesce(disruption["description"], F.lit("")),
        "affected_stops_json": F.to_json(stops),
    }
