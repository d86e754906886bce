"""The supplied tables in the shapes of bronze: customers as profiles, events as line status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.functions.payload import json_text
from linepulse.operators.upsert import scd1

AS_OF = "2024-02-01"
NOW = "2024-02-01 00:00:00"

# ``view`` is left out, so that the rule on known lines has failures.
SUPPLIED_LINES = ("click", "error", "purchase", "signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def glob_of(sf_dir: str, name: str) -> str:
    """A path a file stream accepts, be the table one file or a folder."""
    return f"{sf_dir}/{name}.parque[t]"


def as_profiles(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "cast(c_custkey as string) as customer_id",
        "c_name as full_name",
        """case when c_custkey % 17 = 0 then concat('bad.', cast(c_custkey as string))
                when c_custkey % 19 = 0 then ''
                else concat('user', cast(c_custkey as string), '@example.com') end as email""",
        """case when c_custkey % 101 = 0 then date'2999-01-01'
                when c_custkey % 103 = 0 then null
                when c_custkey % 107 = 0 then date'1900-01-01'
                else date_add(date'1940-01-01', cast(c_custkey * 37 % 25000 as int))
           end as date_of_birth""",
        "concat('07', lpad(cast(c_custkey as string), 9, '0')) as telephone_number",
        """concat('AB', cast(c_custkey % 20 + 1 as string), ' ',
                  cast(c_custkey % 9 + 1 as string), 'CD') as home_postcode""",
        "lpad(cast(c_custkey as string), 12, '0') as card_id",
        """case when c_custkey % 97 = 0 then null
                else concat('Station ', cast(c_nationkey as string)) end as home_station""",
        """concat('[2024-01-0', cast(c_custkey % 9 + 1 as string), ' | Staff] Spoke on ',
                  case c_custkey % 4
                    when 0 then concat('07', lpad(cast(c_custkey as string), 9, '0'))
                    when 1 then c_name
                    when 2 then concat('user', cast(c_custkey as string), '@example.com')
                    else concat('AB', cast(c_custkey % 20 + 1 as string), ' ',
                                cast(c_custkey % 9 + 1 as string), 'CD') end,
                  '.', chr(10), chr(10),
                  '[2024-01-1', cast(c_custkey % 9 as string),
                  ' | Customer] Alerts are useful.') as customer_notes""",
        """cast(date_add(date'2024-01-05', cast(c_custkey % 25 as int)) as timestamp_ntz)
           as _inserted_at""",
        """cast(date_add(date'2024-01-05', cast(c_custkey % 25 as int)) as timestamp_ntz)
           as _updated_at""",
    )


def as_status(events: DataFrame) -> DataFrame:
    # A generator parses the JSON once per row, even when a filter uses what it gives.
    parsed = events.select(
        "event_id", "ts", "user_id", "event_type", F.json_tuple("props", "k").alias("text")
    )
    keyed = parsed.withColumn("k", F.col("text").cast("int")).selectExpr(
        "event_id as row_id",
        "event_type as line_id",
        "concat('Station ', cast(user_id % 25 as string)) as station_name",
        "case when k = 99 then -1 else k % 21 end as status_severity",
        "ts",
    )
    return keyed.selectExpr(
        "row_id",
        "line_id",
        "concat('Line ', upper(line_id)) as line_name",
        "station_name",
        "status_severity",
        """case when status_severity < 0 then 'Unknown' when status_severity < 4 then 'Severe'
                when status_severity < 10 then 'Minor' when status_severity = 10 then 'Good Service'
                else 'Other' end as status_severity_description""",
        """case when status_severity = 10 then ''
                else concat('reason ', cast(row_id % 7 as string)) end as disruption_reason""",
        """case when status_severity = 10 then ''
                else concat('detail ', cast(row_id % 13 as string)) end as disruption_description""",
        """concat('["', station_name, '"]') as affected_stops_json""",
        "ts as _inserted_at",
        "ts as _updated_at",
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_profiles(table(spark, sf_dir, "customer"))


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_status(table(spark, sf_dir, "events"))


def as_struct(status_rows: DataFrame) -> Column:
    return F.struct(*[c for c in status_rows.columns if c != "row_id"])


def line_record(row: str = "row") -> Column:
    """A status row, held in the struct column ``row``, as a record of the feed."""
    s = F.col(row)
    stop = F.struct(F.lit(None).cast("string").alias("commonName"), s["station_name"].alias("name"))
    disruption = F.struct(
        s["disruption_description"].alias("description"), F.array(stop).alias("affectedStops")
    )
    return F.struct(
        s["line_id"].alias("id"),
        s["line_name"].alias("name"),
        F.array(
            F.struct(
                s["status_severity"].alias("statusSeverity"),
                s["status_severity_description"].alias("statusSeverityDescription"),
                s["disruption_reason"].alias("reason"),
                disruption.alias("disruption"),
            )
        ).alias("lineStatuses"),
    )


def feed(status_rows: DataFrame) -> DataFrame:
    """A feed document per hour, holding the latest status of each line in that hour."""
    hourly = status_rows.withColumn(
        "run_ts", F.date_trunc("hour", "_updated_at").cast("timestamp_ntz")
    )
    newest = scd1(hourly, ["run_ts", "line_id"], ["_updated_at", "row_id"]).select(
        "run_ts", as_struct(status_rows).alias("row")
    )
    return (
        newest.groupBy("run_ts")
        .agg(F.sort_array(F.collect_list(line_record())).alias("lines"))
        .select("run_ts", json_text(F.col("lines")).alias("payload"))
    )


def station_lines(spark: SparkSession, sf_dir: str, status_rows: DataFrame) -> DataFrame:
    """The lines of each station: those seen there, and one per region that no feed has."""
    seen = status_rows.select("station_name", "line_id").distinct()
    absent = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("Station "), F.col("n_nationkey").cast("string")).alias("station_name"),
            F.lower("r_name").alias("line_id"),
        )
    )
    return (
        seen.unionByName(absent)
        .groupBy("station_name")
        .agg(F.sort_array(F.collect_set("line_id")).alias("line_ids"))
    )
