"""What the operators share: reading, words, free column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int
) -> DataFrame:
    """``(text, label)`` of at most ``rows`` labelled documents outside the held-out fold.

    The ids with the smallest hashes are taken, so reruns agree. Several labels of one id count
    by their mean, null labels not at all; of repeated ids one row is taken.
    """
    ids = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("double").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull())
        .where(remainder(F.col("id"), folds) != held_out)
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most `rows` ids, so the broadcast is bounded.
    return (
        texts.join(F.broadcast(ids), "id")
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"))
        .orderBy("id")
        .select("text", "label")
    )
