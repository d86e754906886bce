"""The raw status feed as bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.fixed import RETENTION_DAYS
from linepulse.functions.payload import LINE_RECORD, line_fields
from linepulse.functions.temporal import plus_days, utc
from linepulse.tables import LINE_STATUS


def _documents(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("_metadata.file_path").alias("file"),
        utc(F.col("_metadata.file_modification_time")).alias("run_ts"),
        F.col("value").alias("payload"),
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Landed feed documents, one per file, with the time in UTC they were written as the run."""
    return _documents(spark.read.text(path, wholetext=True))


def stream_feed(spark: SparkSession, path: str) -> DataFrame:
    """Like ``read_feed``, as a stream: a checkpoint remembers the files that were read."""
    return _documents(spark.readStream.text(path, wholetext=True))


def broken(raw: DataFrame) -> DataFrame:
    """The documents that ``flatten_status`` has no rows for, and why: they are no JSON array."""
    payload = F.coalesce(F.col("payload"), F.lit(""))
    reason = (
        F.when(payload.rlike(r"^\s*$"), "empty")
        .when(payload.rlike(r"^\s*\{"), "an object, not an array")
        .otherwise("no readable JSON array")
    )
    return raw.filter(F.from_json("payload", "array<string>").isNull()).withColumn("reason", reason)


def station_pairs(station_lines: DataFrame) -> DataFrame:
    """``(station_name, line_ids)`` as one row per station and line."""
    return station_lines.select("station_name", F.explode("line_ids").alias("line_id"))


def line_records(raw: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per run and mapped line, with the text of its record or NULL.

    ``raw`` holds ``(run_ts, payload)``, the payload being the JSON array of one
    run. A repeated line counts with its last record; records of lines that are not mapped, or of
    none, give no row. A payload that is no JSON array gives no rows here; ``broken`` finds those.

    A document is walked once in its own row: its records are sorted by line and last first, the first of
    each line stays, and the mapped lines without one are added. The mapped lines reach the rows as a
    scalar subquery; the array is never longer than the rows its run has to produce anyway.
    """
    mapped = pairs.agg(F.collect_set("line_id")).scalar()
    numbered = F.transform(
        "records",
        lambda r, i: F.struct(F.get_json_object(r, "$.id").alias("line_id"), (-i).alias("newest"), r.alias("raw_record")),
    )
    # Of equal neighbours in the sorted array the first is the newest.
    first = lambda e, i: (i == 0) | (F.get("sorted", i - 1)["line_id"] != e["line_id"])
    # Missing lines, with no record beside them.
    missing = F.arrays_zip(F.array_except(mapped, F.col("ids")), F.array().cast("array<string>"))
    record = "array<struct<line_id: string, raw_record: string>>"
    return (
        raw.select("run_ts", F.from_json("payload", "array<string>").alias("records"))
        .filter(F.col("records").isNotNull())
        .withColumn("sorted", F.sort_array(F.filter(numbered, lambda e: e["line_id"].isNotNull())))
        .withColumn("latest", F.filter("sorted", first))
        .select(
            "run_ts",
            F.transform("latest", lambda e: e["line_id"]).alias("ids"),
            F.transform("latest", lambda e: F.struct(e["line_id"], e["raw_record"])).cast(record).alias("found"),
        )
        .select("run_ts", F.inline(F.concat("found", missing.cast(record))))
        .join(pairs.select("line_id").distinct(), "line_id", "left_semi")
        .select("run_ts", "line_id", "raw_record")
    )


def flatten_status(raw: DataFrame, station_lines: DataFrame) -> DataFrame:
    """One bronze row per run, station and line, whether or not the feed has the line.

    Records are parsed once per run and line, before they fan out to stations.
    The join is left to Catalyst: the mapping is broadcast when its size allows.
    """
    pairs = station_pairs(station_lines)
    parsed = line_records(raw, pairs).withColumn("record", F.from_json("raw_record", LINE_RECORD))
    lines = parsed.select(
        "run_ts",
        "line_id",
        F.coalesce("raw_record", F.lit("{}")).alias("raw_payload"),
        *[c.alias(n) for n, c in line_fields(F.col("record"), F.col("line_id")).items()],
    )
    rows = lines.join(pairs, "line_id")
    return stamp(rows, RETENTION_DAYS["operational"], at="run_ts").select(LINE_STATUS.column_names)


def stamp(df: DataFrame, days: int, at: str) -> DataFrame:
    """Add the platform columns; ``at`` names the column with the time of the run."""
    return df.withColumns(
        {
            "_inserted_at": F.col(at),
            "_updated_at": F.col(at),
            "_delete_at": plus_days(F.col(at), days),
        }
    )
