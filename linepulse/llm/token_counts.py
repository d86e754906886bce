"""Token totals by source, language and tokenizer version, kept up by signed changes.

A batch holds inserted, deleted and revised counts of documents. It is reduced to signed sums per
group and written to a folder named after it; totals are the sums over the batches. A batch counts
once its folder is marked as complete. Delivered again it is skipped, and after a failure its
folder is written anew, so every batch counts exactly once.

Null sources and languages are groups of their own; null counts are zero. An insert of a repeated
row counts twice, as two documents. Groups without documents and tokens are not returned. A
rollup without batches is empty.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepulse.llm.common import word_count
from linepulse.llm.token_files import token_count
from linepulse.scratch import stage

GROUP = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, docs long, tokens long"
_NAME = re.compile(r"[A-Za-z0-9._-]+")


def counts(docs: DataFrame, tokenizers: dict[str, str | None]) -> DataFrame:
    """``(doc_id, source, lang, version, tokens)``: one row per document and tokenizer version.

    ``tokenizers`` gives each version its tokenizer file; None counts words.
    """
    text = F.col("text")
    found = [
        (token_count(text, path) if path else word_count(text)).alias(f"count_{i}")
        for i, path in enumerate(tokenizers.values())
    ]
    # Written before they are dealt out to rows: else Spark would count once more for a filter.
    rows = stage(docs.select("doc_id", "source", "lang", *found), "token-counts")
    of = [F.struct(F.lit(v).alias("version"), F.col(f"count_{i}").alias("tokens")) for i, v in enumerate(tokenizers)]
    rows = rows.select("doc_id", "source", "lang", F.array(*of).alias("of"))
    return rows.select("doc_id", "source", "lang", F.explode("of").alias("of")).select(
        "doc_id", "source", "lang", "of.version", "of.tokens"
    )


def _signed(rows: DataFrame, docs: int, sign: int) -> DataFrame:
    tokens = sign * F.coalesce(F.col("tokens").cast("long"), F.lit(0))
    return rows.select(*GROUP, F.lit(docs).cast("long").alias("docs"), tokens.alias("tokens"))


def inserted(rows: DataFrame) -> DataFrame:
    return _signed(rows, 1, 1)


def deleted(rows: DataFrame) -> DataFrame:
    return _signed(rows, -1, -1)


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old counts go and the new ones come; a document may change its group."""
    return deleted(old).union(inserted(new))


class Rollup:
    """The batches in one folder, which all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _batch(self, name: str) -> str:
        if not _NAME.fullmatch(name) or name.startswith((".", "_")):
            raise ValueError(f"no name for a batch: {name}")
        return f"{self.folder}/{name}"

    def _path(self, name: str):  # noqa: ANN202 - a path and its file system, of the JVM
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _complete(self, folder: str) -> bool:
        mark, store = self._path(f"{folder}/_SUCCESS")
        return store.exists(mark)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add signed ``changes``; False if the batch was there already."""
        folder = self._batch(batch)
        if self._complete(folder):
            return False
        sums = changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.mode("overwrite").parquet(folder)
        return True

    def batches(self) -> list[str]:
        path, store = self._path(self.folder)
        if not store.exists(path):
            return []
        names = sorted(s.getPath().getName() for s in store.listStatus(path) if s.isDirectory())
        return [n for n in names if self._complete(f"{self.folder}/{n}")]

    def totals(self) -> DataFrame:
        """``(source, lang, version, docs, tokens)`` over all complete batches."""
        folders = [f"{self.folder}/{n}" for n in self.batches()]
        rows = self.spark.read.schema(SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where(
            "docs != 0 OR tokens != 0"
        )
