"""The five tables: columns, comments, layout and properties."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from linepulse.fixed import JOURNEY_TAGS, TARGET_TAGS, TS


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str, str], ...]
    comment: str
    purpose: str
    freshness_sla: str
    cluster_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    #: Hash buckets of the keys that a new table is laid out in; choose so that one bucket suits one task.
    buckets: int = 0
    #: Compared, but left out of the hash: specs are keys of dictionaries, and a dictionary has none.
    tags: Mapping[str, str] = field(default_factory=dict, hash=False)

    @property
    def column_names(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    @property
    def change_feed(self) -> bool:
        return self.keys == ("customer_id", "line_id")

    @property
    def properties(self) -> dict[str, str]:
        props = {"platform.freshness_sla": self.freshness_sla}
        if self.change_feed:
            props["platform.change_feed"] = "true"
        return props


def _platform() -> tuple[tuple[str, str, str], ...]:
    return (
        ("_inserted_at", TS, "When the data first entered the platform"),
        ("_updated_at", TS, "When the data was last written in bronze"),
        ("_delete_at", TS, "When the row may be removed"),
    )


_STATUS = (
    ("line_id", "string", "Line"),
    ("line_name", "string", "Line as shown"),
    ("status_severity", "integer", "10 is good service, lower is disrupted, -1 unknown"),
    ("status_severity_description", "string", "Severity in words"),
    ("disruption_reason", "string", "Reason, empty when none"),
    ("disruption_description", "string", "Detail, empty when none"),
    ("affected_stops_json", "string", "JSON array of stop names"),
)

_PROFILE = (
    ("customer_id", "string", "Customer"),
    ("full_name", "string", "Name"),
    ("email", "string", "Address for alerts"),
    ("date_of_birth", "date", "Date of birth"),
    ("telephone_number", "string", "Telephone"),
    ("home_postcode", "string", "Postcode"),
    ("card_id", "string", "Travel card"),
    ("home_station", "string", "Station the customer travels from"),
)

LINE_STATUS = TableSpec(
    name="line_status",
    columns=(
        ("raw_payload", "string", "The line's record as received"),
        ("station_name", "string", "Station served by the line"),
        *_STATUS,
        *_platform(),
    ),
    comment="Line status per station and line, appended on every run",
    purpose="operational",
    freshness_sla="30m",
    cluster_by=("line_id", "_inserted_at"),
)

CUSTOMER_PROFILES = TableSpec(
    name="customer_profiles",
    columns=(
        ("raw_payload", "string", "The profile as received"),
        *_PROFILE,
        ("customer_notes", "string", "Free text; may hold personal data"),
        *_platform(),
    ),
    comment="Customer profiles, replaced on every run",
    purpose="profile",
    freshness_sla="1d",
)

CUSTOMER_JOURNEYS = TableSpec(
    name="customer_journeys",
    columns=(*_PROFILE, *_STATUS, *_platform()[:2], ("age", "integer", "Whole years"), _platform()[2]),
    comment="Latest disruption per customer and line; holds personal data",
    purpose="alerting",
    freshness_sla="1d",
    cluster_by=("home_station", "customer_id"),
    keys=("customer_id", "line_id"),
    buckets=64,
    tags=JOURNEY_TAGS,
)

DISRUPTION_SUMMARY = TableSpec(
    name="disruption_summary",
    columns=(
        ("line_id", "string", "Line"),
        ("line_name", "string", "Line as shown"),
        ("disruption_date", "date", "Day of the latest state"),
        ("status_severity_description", "string", "Severity in words"),
        ("affected_customers", "long", "Customers of the group"),
        ("affected_stations", "long", "Distinct home stations"),
        ("disruption_description", "string", "Detail of the newest row"),
        ("last_updated", TS, "Newest row of the group"),
        *_platform(),
    ),
    comment="Disruptions by line, day and severity; no personal data",
    purpose="operational",
    freshness_sla="1h",
    keys=("line_id", "line_name", "disruption_date", "status_severity_description"),
    buckets=16,
)

# Behind the summary: what its groups are made of, so that changed journeys can be added and taken away.
DISRUPTION_COUNTS = TableSpec(
    name="disruption_counts",
    columns=(
        *((c, k, t) for c, k, t in DISRUPTION_SUMMARY.columns[:4]),
        ("home_station", "string", "Station of the customers"),
        ("disruption_description", "string", "Detail"),
        ("journeys", "long", "Journeys of the station, line, day, severity and detail"),
        ("customers", "long", "Those with a customer"),
        *(
            column
            for kind in ("newest", "oldest", "inserted")
            for column in ((kind, TS, f"The {kind} time"), (f"{kind}_journeys", "long", "Journeys that have it"))
        ),
    ),
    comment="Journeys counted per station and detail; kept by signed changes",
    purpose="operational",
    freshness_sla="1h",
    keys=DISRUPTION_SUMMARY.keys,
    buckets=16,
)

NOTIFICATION_TARGETS = TableSpec(
    name="notification_targets",
    columns=(
        ("customer_id", "string", "Customer"),
        ("full_name", "string", "Name"),
        ("email", "string", "Address for alerts"),
        ("home_station", "string", "Station the customer travels from"),
        ("line_id", "string", "Line"),
        ("line_name", "string", "Line as shown"),
        ("status_severity_description", "string", "Severity in words"),
        ("disruption_reason", "string", "Reason, empty when none"),
        ("disruption_description", "string", "Detail, empty when none"),
        *_platform(),
    ),
    comment="One row per affected customer and line; holds personal data",
    purpose="alerting",
    freshness_sla="1d",
    keys=("customer_id", "line_id"),
    buckets=64,
    tags=TARGET_TAGS,
)

FEED_QUARANTINE = TableSpec(
    name="feed_quarantine",
    columns=(
        ("file", "string", "File of the document"),
        ("reason", "string", "Why no status could be read"),
        ("payload", "string", "The document as received"),
        *_platform(),
    ),
    comment="Feed documents that could not be read",
    purpose="operational",
    freshness_sla="1d",
)

# Profiles that broke a rule and therefore have no journeys, of the last refresh.
PROFILE_REJECTS = TableSpec(
    name="profile_rejects",
    columns=(
        *_PROFILE,
        ("broken_rules", "array<string>", "Names of the rules"),
        *_platform(),
    ),
    comment="Profiles without journeys, and the rules they break; holds personal data",
    purpose="profile",
    freshness_sla="1d",
    tags=JOURNEY_TAGS,
)

ALL_TABLES = (
    LINE_STATUS, CUSTOMER_PROFILES, CUSTOMER_JOURNEYS, DISRUPTION_SUMMARY, NOTIFICATION_TARGETS,
)
