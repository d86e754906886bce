"""Tags on columns, masking by audience, and finding personal data.

Tags live in the schema's metadata. They follow a column through renames, joins
and Parquet, and are lost when an expression makes a new column of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.fixed import CLASS_EMAIL, CLASS_LOCATION, CLASS_NAME, CLASS_PHONE, EXEMPT_AUDIENCES
from linepulse.functions.masks import MASKS

TAG = "class"

# What the scan looks for, anywhere in a text. What the first pattern finds is
# cheap and part of every match, so most texts never meet the second. A phone
# number has nine or ten digits after its prefix, with blanks, hyphens or brackets between.
PII_PATTERNS = {
    CLASS_EMAIL: ("@", r"[A-Za-z0-9._%+\-]@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"),
    CLASS_PHONE: (
        r"[0-9 ()\-]{10}",
        r"(?:\+44(?: ?\(0\))?|\(?\b0)(?:[ ()\-]{0,2}[0-9]){9,10}\b",
    ),
    CLASS_LOCATION: ("[A-Z][0-9]", r"\b[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}\b"),
}

# The start of an entry in customer notes: a date and who wrote it.
NOTE_SPLIT = r"\n\n(?=\[\d{4}-)"
NOTE_ENTRY = r"(?s)^\[(\d{4}-\d{2}-\d{2}) \| (Staff|Customer)\] (.*)$"


def tag_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Set the class of columns; setting it again changes nothing."""
    for column, cls in tags.items():
        kept = dict(df.schema[column].metadata or {})
        df = df.withMetadata(column, {**kept, TAG: cls})
    return df


def tags_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG] for f in df.schema.fields if TAG in (f.metadata or {})}


def tag_coverage(df: DataFrame) -> DataFrame:
    """One row per tagged column: its class, and rows with and without a value."""
    tags = tags_of(df)
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{c}") for c in tags]
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(cls).alias("tag"),
                F.col(f"n_{c}").alias("non_null"),
            )
            for c, cls in tags.items()
        ]
    )
    return totals.select(F.inline(per_column), "rows")


def mask_for_audience(df: DataFrame, audience: str) -> DataFrame:
    """Mask every tagged column by its class, unless the audience is exempt.

    A class without a mask hides the whole value.
    """
    if audience in EXEMPT_AUDIENCES:
        return df

    def masked(column: str, cls: str) -> Column:
        if cls in MASKS:
            return MASKS[cls](F.col(column))
        return F.lit(None).cast(df.schema[column].dataType)

    tags = tags_of(df)
    return df.select(
        [
            masked(c, tags[c]).alias(c, metadata={TAG: tags[c]}) if c in tags else F.col(c)
            for c in df.columns
        ]
    )


def matches(text: Column, cls: str) -> Column:
    cheap, pattern = PII_PATTERNS[cls]
    return text.rlike(cheap) & text.rlike(pattern)


def pii_scan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each text column that match each class, in one pass over whole texts.

    ``proposed`` marks a class found in a column that carries no tag yet.
    """
    tags = tags_of(df)
    cells = [(c, cls) for c in columns for cls in PII_PATTERNS]
    totals = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.count_if(matches(F.col(c), cls)).alias(f"{c}:{cls}") for c, cls in cells],
    )
    per_cell = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(cls).alias("tag"),
                F.col(f"n_{c}").alias("rows"),
                F.col(f"`{c}:{cls}`").alias("matches"),
                ((F.col(f"`{c}:{cls}`") > 0) & F.lit(c not in tags)).alias("proposed"),
            )
            for c, cls in cells
        ]
    )
    return totals.select(F.inline(per_cell))


def explode_notes(profiles: DataFrame) -> DataFrame:
    """One row per entry of the customer notes.

    Entries start at a bracketed date; blank lines inside an entry stay in it.
    An entry without that head keeps its text and has no date and author.
    """
    entries = profiles.select(
        *[c for c in profiles.columns if c != "customer_notes"],
        F.posexplode(F.split("customer_notes", NOTE_SPLIT)).alias("pos", "entry"),
    )
    entry = F.col("entry")
    headed = entry.rlike(NOTE_ENTRY)
    return entries.withColumns(
        {
            "note_date": F.when(headed, F.regexp_extract(entry, NOTE_ENTRY, 1).try_cast("date")),
            "author": F.when(headed, F.regexp_extract(entry, NOTE_ENTRY, 2)),
            "note_text": F.when(headed, F.regexp_extract(entry, NOTE_ENTRY, 3)).otherwise(entry),
        }
    ).drop("entry")


OWN_PII = {
    CLASS_NAME: "full_name",
    CLASS_EMAIL: "email",
    CLASS_PHONE: "telephone_number",
    CLASS_LOCATION: "home_postcode",
}


def notes_own_pii(profiles: DataFrame) -> DataFrame:
    """The note entries that hold their own customer's data, one row per class found."""
    notes = explode_notes(
        profiles.select("customer_id", *OWN_PII.values(), "customer_notes")
    )
    found = F.array(
        *[
            F.when(
                (F.trim(F.col(column)) != "") & F.col("note_text").contains(F.col(column)), F.lit(cls)
            )
            for cls, column in OWN_PII.items()
        ]
    )
    return notes.select(
        "customer_id", "pos", "note_date", "author", F.explode(F.array_compact(found)).alias("tag")
    )
