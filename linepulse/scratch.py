"""Where jobs keep intermediate tables, and how they cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _folder_of_this_machine() -> str:
    return tempfile.mkdtemp(prefix="linepulse-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session that is known to run inside this process alone may fall back to a temporary
    folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or ""):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _folder_of_this_machine()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/linepulse/{label}-{uuid.uuid4().hex}"


def make_dir(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job has written; absent ones are fine."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, which may be absent."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.listStatus(at) if store.exists(at) else []
    return [s.getPath().getName() for s in found if s.isDirectory()]


def _files(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.listStatus(at) if store.exists(at) else []
    return store, at, [s.getPath() for s in found if s.isFile()]


def remove_files(spark: SparkSession, path: str, prefix: str) -> None:
    """Delete a folder's files whose names begin with ``prefix``."""
    store, _, files = _files(spark, path)
    for file in files:
        if file.getName().startswith(prefix):
            store.delete(file, False)


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move the data files of a folder to another one, with ``prefix`` before their names."""
    store, _, files = _files(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    for file in files:
        if not file.getName().startswith(("_", ".")):
            moved = spark._jvm.org.apache.hadoop.fs.Path(to, f"{prefix}{file.getName()}")
            if not store.rename(file, moved):
                raise OSError(f"{file} could not be moved to {moved}")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote a folder has ended."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives lost executors, and Spark knows its size from the files.
    """
    return _stage(df, fresh_path(df.sparkSession, label))


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like ``stage``, for a job that ends inside the block: the copy is removed after it."""
    path = fresh_path(df.sparkSession, label)
    try:
        yield _stage(df, path)
    finally:
        remove(df.sparkSession, path)
