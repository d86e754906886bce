"""Tables in the session catalog: create, write, reconcile.

A write that replaces rows goes to a folder of its own, and the catalog is pointed there once it has
ended. A failure before that leaves the old rows. The folder that was replaced is then removed, so a
query that began before and still reads it fails, as with any overwrite of files.

Tables whose spec names buckets are partitioned by a hash of their keys; see ``replace_buckets``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from linepulse.functions.payload import json_text
from linepulse.scratch import folders, move_files, remove, remove_files
from linepulse.tables import TableSpec

#: The partition column of bucketed tables; its metadata holds the number of buckets.
BUCKET = "_bucket"
#: Suffix of the table that is about to take another's place.
NEXT = "__next"
#: Partitions that are added in one statement.
_ADDED = 500


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of ``spec`` in order and type, with their comments and the tags of ``df``.

    Text that does not parse becomes NULL.
    """

    def typed(name: str, kind: str, comment: str) -> Column:
        kept = dict(df.schema[name].metadata or {})
        return F.col(name).try_cast(kind).alias(name, metadata={**kept, "comment": comment})

    return df.select([typed(*column) for column in spec.columns])


def with_raw(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the record as JSON next to its parsed columns."""
    return df.withColumn("raw_payload", json_text(F.struct(*columns)))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _props(properties: dict[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())


def ensure_table(
    spark: SparkSession,
    spec: TableSpec,
    schema: str,
    location: str | None = None,
    buckets: int | None = None,
) -> str:
    """Create schema and table if absent and return the table's full name.

    ``location`` is the folder of a new schema; its tables live below it. ``buckets`` is for a new
    table whose spec has buckets, in place of the spec's number.
    """
    at = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{at}")
    table = f"{schema}.{spec.name}"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(table + NEXT):
        # A replacement was interrupted after its rows were complete.
        spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
    if spec.buckets:
        if not spark.catalog.tableExists(table):
            empty = spark.createDataFrame([], _bucketed_schema(spec, buckets or spec.buckets))
            empty.write.partitionBy(BUCKET).mode("ignore").format("parquet").saveAsTable(table)
        spark.sql(f"COMMENT ON TABLE {table} IS {_text(spec.comment)}")
        set_properties(spark, table, spec.properties)
        return table
    columns = ", ".join(f"`{n}` {t} COMMENT {_text(c)}" for n, t, c in spec.columns)
    layout = f"CLUSTER BY ({', '.join(spec.cluster_by)}) " if spec.cluster_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout}"
        f"COMMENT {_text(spec.comment)} TBLPROPERTIES ({_props(spec.properties)})"
    )
    return table


def _bucketed_schema(spec: TableSpec, buckets: int) -> StructType:
    found = StructType()
    for name, kind, comment in spec.columns:
        tag = {"class": spec.tags[name]} if name in spec.tags else {}
        found = found.add(name, kind, True, {"comment": comment, **tag})
    return found.add(BUCKET, "integer", True, {"comment": "Hash of the key", "buckets": buckets})


def rows_of(spark: SparkSession, table: str) -> DataFrame:
    """A table's rows without the column of its buckets."""
    return spark.table(table).drop(BUCKET)


def buckets_of(spark: SparkSession, table: str) -> int:
    """Into how many buckets a table is laid out; 0 if it has none."""
    found = [f.metadata["buckets"] for f in spark.table(table).schema if f.name == BUCKET]
    return found[0] if found else 0


def with_bucket(df: DataFrame, keys: Iterable[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def numbers(buckets: DataFrame) -> list[int]:
    """The distinct buckets of some rows, never more than the table has."""
    return sorted(r[0] for r in buckets.select(BUCKET).distinct().collect())


def location_of(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'")
    return described.collect()[-1].data_type


def _parents(files: Iterable[str]) -> set[str]:
    return {f.rsplit("/", 1)[0] for f in files}


def seen_by(spark: SparkSession, table: str, change: str) -> set[int]:
    """The buckets of a table that hold what ``replace_buckets`` wrote under the name ``change``."""
    found = (re.search(rf"/rows-{change}-[^/]*/{BUCKET}=(\d+)/", f) for f in spark.table(table).inputFiles())
    return {int(m[1]) for m in found if m}


def replace_buckets(
    rows: DataFrame, table: str, touched: Iterable[int], change: str, sort: Iterable[str] = ()
) -> None:
    """Make ``rows``, which carry their bucket, the whole content of the ``touched`` buckets of a table.

    Each bucket is written to a new folder by one task, and its partition is pointed there once all
    are written; a bucket without rows is dropped. Files of other buckets are not opened. A failure
    while writing changes nothing; one in between leaves whole buckets, old or new. ``change`` is part
    of the folder's name: ``seen_by`` tells which buckets are new, so that a job can go on with the
    others. ``sort`` names columns that the rows of a bucket are sorted by.
    """
    spark = rows.sparkSession
    home = f"{location_of(spark, table)}/rows-{change}-{uuid.uuid4().hex[:8]}"
    touched = sorted(touched)
    mine = F.col(BUCKET).isin(touched)
    old = _parents(spark.table(table).where(mine).inputFiles())
    layout = rows.where(mine).repartition(BUCKET).sortWithinPartitions(BUCKET, *sort)
    _written(spark, layout.write.partitionBy(BUCKET), home)
    written = {int(f.split("=")[1]) for f in folders(spark, home) if f.startswith(BUCKET)}
    known = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}

    def part(bucket: int) -> str:
        return f"PARTITION ({BUCKET} = {bucket})"

    def at(bucket: int) -> str:
        return f"LOCATION {_text(f'{home}/{BUCKET}={bucket}')}"

    for bucket in sorted(written & known):
        spark.sql(f"ALTER TABLE {table} {part(bucket)} SET {at(bucket)}")
    added = sorted(written - known)
    for i in range(0, len(added), _ADDED):
        places = " ".join(f"{part(b)} {at(b)}" for b in added[i : i + _ADDED])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {places}")
    for bucket in sorted(set(touched) & known - written):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {part(bucket)}")
    for folder in old:
        remove(spark, folder)


def set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_props(properties)})")


def table_properties(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {table}")


def _writer(df: DataFrame, spec: TableSpec) -> DataFrameWriter:
    """Rows conform to the table; each task sorts its own by the layout columns.

    That makes row groups narrow in these columns without a shuffle.
    """
    rows = conform(df, spec)
    if not spec.cluster_by:
        return rows.write
    return rows.sortWithinPartitions(*spec.cluster_by).write.clusterBy(*spec.cluster_by)


def append(df: DataFrame, table: str, spec: TableSpec) -> None:
    """Append a batch and re-apply the table's properties."""
    _writer(df, spec).mode("append").saveAsTable(table)
    set_properties(df.sparkSession, table, spec.properties)


def append_once(df: DataFrame, table: str, spec: TableSpec, name: str) -> None:
    """Append rows in files that begin with ``name``; files of an earlier try of that name go first.

    The rows are written to a folder that readers pass over, and the finished files are moved out of it.
    """
    spark = df.sparkSession
    home = location_of(spark, table)
    remove_files(spark, home, f"{name}-")
    aside = f"{home}/_incoming-{name}"
    remove(spark, aside)
    _written(spark, _sorted(conform(df, spec), spec).write, aside)
    move_files(spark, aside, home, f"{name}-")
    remove(spark, aside)
    spark.catalog.refreshTable(table)
    set_properties(spark, table, spec.properties)


def overwrite(df: DataFrame, table: str, spec: TableSpec) -> None:
    """Replace the rows of a table, and its schema where types or tags differ.

    The rows are written beside the old ones, and then the catalog is pointed to them: a failure in
    them leaves the old rows as they are, and ``df`` may read the table. Where the schema differs, a
    second table takes the place of the first; ``ensure_table`` completes that if it is interrupted.
    """
    spark = df.sparkSession
    rows, buckets = conform(df, spec), buckets_of(spark, table)
    change = uuid.uuid4().hex
    if rows_of(spark, table).schema.jsonValue() != _nullable(rows.schema).jsonValue():
        _replace_table(rows, table, spec, buckets, change)
    elif buckets:
        replace_buckets(with_bucket(rows, spec.keys, buckets), table, list(range(buckets)), change, spec.cluster_by)
    else:
        old = location_of(spark, table)
        new = _beside(old, change)
        _written(spark, _sorted(rows, spec).write, new)
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(new)}")
        remove(spark, old)
    set_properties(spark, table, spec.properties)


def _beside(old: str, change: str) -> str:
    """A new folder in the folder of the table's old one, under the table's name."""
    above, name = old.rstrip("/").rsplit("/", 1)
    return f"{above}/{name.split('--')[0]}--{change}"


def _sorted(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.sortWithinPartitions(*spec.cluster_by) if spec.cluster_by else rows


def _written(spark: SparkSession, writer: DataFrameWriter, path: str, table: str | None = None) -> None:
    try:
        if table:
            writer.option("path", path).format("parquet").saveAsTable(table)
        else:
            writer.parquet(path)
    except Exception:
        remove(spark, path)
        raise


def _replace_table(rows: DataFrame, table: str, spec: TableSpec, buckets: int, change: str) -> None:
    spark = rows.sparkSession
    old = location_of(spark, table)
    follower = table + NEXT
    spark.sql(f"DROP TABLE IF EXISTS {follower}")
    if buckets:
        mark = {"comment": "Hash of the key", "buckets": buckets}
        laid = with_bucket(rows, spec.keys, buckets).withMetadata(BUCKET, mark)
        writer = laid.repartition(BUCKET).write.partitionBy(BUCKET)
    else:
        writer = _sorted(rows, spec).write
        writer = writer.clusterBy(*spec.cluster_by) if spec.cluster_by else writer
    _written(spark, writer, _beside(old, change), follower)
    spark.sql(f"COMMENT ON TABLE {follower} IS {_text(spec.comment)}")
    kept = {r.key: r.value for r in table_properties(spark, table).collect() if r.key.startswith("platform.")}
    if kept:
        set_properties(spark, follower, kept)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {follower} RENAME TO {table}")
    remove(spark, old)


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
