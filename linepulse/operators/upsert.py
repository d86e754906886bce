"""Latest row per key (SCD type 1) and the difference between two states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def scd1(source: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest ``sequence_by``, so late rows lose.

    ``sequence_by`` has to order the rows of a key totally. Spark cuts each task
    to one row per key before the shuffle, so a hot key costs one row per task.
    Where that cut is switched off, partial aggregation does the same.
    """
    if int(source.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")) < 1:
        best = F.max_by(F.struct(*source.columns), F.struct(*sequence_by)).alias("_best")
        return source.groupBy(*keys).agg(best).select("_best.*")
    order = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in sequence_by])
    return (
        source.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]
) -> DataFrame:
    """``target`` after ``batch``: update or insert by key, never delete."""
    return scd1(target.unionByName(batch), keys, sequence_by)


def batch_changes(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]
) -> DataFrame:
    """What ``upsert(target, batch)`` changes, as rows with ``_change_type``.

    Only the keys of the batch are looked up in the target; nothing is deleted.
    """
    newest = scd1(batch, keys, sequence_by)
    row = F.struct(*newest.columns)
    old = target.select(*keys, F.struct(*newest.columns).alias("_old"))
    both = newest.select(*keys, row.alias("_new")).join(old, list(keys), "left")
    order = [F.struct(*[F.col(f"{side}.{c}") for c in sequence_by]) for side in ("_new", "_old")]
    changed = F.col("_old").isNull() | ((order[0] > order[1]) & (F.col("_new") != F.col("_old")))
    kind = F.when(F.col("_old").isNull(), "insert").otherwise("update")
    return both.where(changed).select(kind.alias("_change_type"), "_new.*")


def changes(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two states of a keyed table.

    ``_change_type`` is insert, update or delete; a deleted row shows its last
    values, the others their current ones.
    """
    columns = current.columns
    old = previous.select(F.struct(*columns).alias("old"), *[F.col(k).alias(f"_old_{k}") for k in keys])
    new = current.select(F.struct(*columns).alias("new"), *[F.col(k).alias(f"_new_{k}") for k in keys])
    same_key = None
    for key in keys:
        match = F.col(f"_old_{key}") == F.col(f"_new_{key}")
        same_key = match if same_key is None else same_key & match
    both = old.join(new, same_key, "full_outer")
    kind = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .otherwise("update")
    )
    return (
        both.filter(~F.col("old").eqNullSafe(F.col("new")))
        .select(kind.alias("_change_type"), F.coalesce("new", "old").alias("row"))
        .select("_change_type", "row.*")
    )
