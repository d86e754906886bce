"""Values that results depend on."""

# Severity codes, defaults of a missing status, rules and windows.
GOOD_SERVICE = 10
UNKNOWN_SEVERITY = -1
UNKNOWN_DESCRIPTION = "Unknown"
EARLIEST_BIRTH = "1900-01-01"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\z"
KNOWN_LINE_IDS = (
    "bakerloo", "central", "circle", "district", "elizabeth",
    "hammersmith-city", "jubilee", "metropolitan", "northern",
    "piccadilly", "victoria", "waterloo-city",
)
RECENT_DAYS = 30
TOP_STATIONS = 20

# Days a row is kept, by the purpose it is kept for.
RETENTION_DAYS = {"operational": 730, "profile": 730, "alerting": 365}

# Classes of personal data and the audiences that see them unmasked.
CLASS_NAME = "class.name"
CLASS_EMAIL = "class.email_address"
CLASS_BIRTH = "class.date_of_birth"
CLASS_LOCATION = "class.location"
CLASS_PHONE = "class.phone_number"
EXEMPT_AUDIENCES = ("pii-readers", "data-stewards")
JOURNEY_TAGS = {
    "full_name": CLASS_NAME,
    "email": CLASS_EMAIL,
    "date_of_birth": CLASS_BIRTH,
    "home_postcode": CLASS_LOCATION,
}
TARGET_TAGS = {"full_name": CLASS_NAME, "email": CLASS_EMAIL}
MASKED_NAME = "***MASKED***"

# Platform timestamps hold UTC wall-clock time, so no result depends on the
# time zone of the session.
TS = "timestamp_ntz"
