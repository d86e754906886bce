"""Data-quality rules: named predicates. A predicate that is NULL counts as failed."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linepulse.scratch import fresh_path, remove

#: The column of a row's broken rules, a bit each; so there may be 62 rules.
BROKEN = "_broken_rules"

Rules = Mapping[str, Column]


def holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def expect_warn(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """All rows, and how many break each rule, counted by the job that consumes them.

    Put it right before the write: a recomputed shuffle stage would count its
    rows twice, the last stage of a job does not. ``dq_report`` is exact anywhere.
    """
    seen = Observation(name)
    counts = [F.count_if(~holds(rule)).alias(rule_name) for rule_name, rule in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def expect_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Only the rows that keep every rule."""
    return df.filter(reduce(lambda a, b: a & b, rules.values()))


def judged(df: DataFrame, rules: Rules, name: str = "judged") -> tuple[DataFrame, Observation]:
    """All rows with a bit per broken rule in ``BROKEN``, and how many rows break each rule.

    Rules are evaluated once per row; what is kept, what is rejected and the counts all come from the
    bits. The counts are those of the job that consumes the rows, see ``expect_warn``.
    """
    bits = [F.when(holds(rule), 0).otherwise(1 << i).cast("long") for i, rule in enumerate(rules.values())]
    marked = df.withColumn(BROKEN, reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")))
    seen = Observation(name)
    counts = [F.count_if(F.col(BROKEN).bitwiseAND(F.lit(1 << i)) != 0).alias(rule) for i, rule in enumerate(rules)]
    return marked.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def kept_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(BROKEN) == 0).drop(BROKEN)


def rejected_rows(marked: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a rule, with the names of those they break in ``broken_rules``."""
    broken = F.array_compact(
        F.array(*[F.when(F.col(BROKEN).bitwiseAND(F.lit(1 << i)) != 0, F.lit(rule)) for i, rule in enumerate(rules)])
    )
    return marked.where(F.col(BROKEN) != 0).withColumn("broken_rules", broken).drop(BROKEN)


@contextmanager
def split_by_rules(
    df: DataFrame, rules: Rules, name: str = "split"
) -> Iterator[tuple[DataFrame, DataFrame, dict[str, int]]]:
    """Kept rows, rejected rows with the rules they break, and counts per rule, from one pass over ``df``.

    The rows are written once, kept and rejected ones apart, and are there inside the block.
    """
    marked, seen = judged(df, rules, f"{name}-{uuid.uuid4().hex}")
    path = fresh_path(df.sparkSession, name)
    try:
        marked.withColumn("_kept", F.col(BROKEN) == 0).write.partitionBy("_kept").parquet(path)
        counts = seen.get
        back = df.sparkSession.read.schema(marked.schema.add("_kept", "boolean")).parquet(path)
        good, bad = (back.where(F.col("_kept") == kept).drop("_kept") for kept in (True, False))
        yield good.drop(BROKEN), rejected_rows(bad, rules), counts
    finally:
        remove(df.sparkSession, path)


def dq_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: rows, failures and their fraction; one pass over ``df``."""
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~holds(rule)).alias(name) for name, rule in rules.items()],
    )
    per_rule = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(name).alias("failed")) for name in rules]
    )
    return totals.select("rows", F.inline(per_rule)).select(
        "rule",
        "rows",
        "failed",
        F.try_divide(F.col("failed"), F.col("rows")).alias("failed_fraction"),
    )
