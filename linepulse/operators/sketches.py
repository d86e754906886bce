"""Profile of a table per window from mergeable sketches.

One pass: each task adds its rows to one sketch per window and column, and only sketches are shuffled;
no value leaves its task. Sketches can be stored and merged over windows later.

Errors, with the default sizes: the distinct count has a relative standard error of 1.04 / sqrt(2 ** lg),
1.6 %; small sets are exact. The rank of a quantile is off by at most 1.65 % of the rows, with 99 %
confidence. Rows, nulls, extremes and means are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from linepulse.fixed import TS

#: Base-2 logarithm of the registers of a distinct count, and items a quantile sketch keeps per level.
LG, K = 12, 200
QUANTILES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def profile_sketches(
    df: DataFrame, ts_col: str, columns: Sequence[str], window: str = "1 day", lg: int = LG, k: int = K
) -> DataFrame:
    """Per window and column: rows, nulls, extremes, total of numbers, and two sketches.

    Extremes of numbers go by size, those of other types by text, both given as text. A column that is
    no number has no total and no quantile sketch. Rows without a time take no part.
    """
    at = F.window(F.col(ts_col).cast(TS), window)["start"].alias("window_start")
    measures = [m for i, c in enumerate(columns) for m in _measures(df, c, i, lg, k)]
    wide = df.groupBy(at).agg(F.count(F.lit(1)).alias("rows"), *measures)
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), "rows",
            *[F.col(f"{name}_{i}").alias(name) for name in ("nulls", "low", "high", "total", "distinct_sketch", "quantile_sketch")],
        )
        for i, c in enumerate(columns)
    ]
    tall = wide.select("window_start", F.inline(F.array(*cells)))
    return tall.select(
        "window_start", "column_name", "rows", "nulls", F.col("low").alias("min_value"), F.col("high").alias("max_value"),
        "total", "distinct_sketch", "quantile_sketch",
    )


def _measures(df: DataFrame, name: str, i: int, lg: int, k: int) -> list[Column]:
    kind = df.schema[name].dataType
    number = isinstance(kind, NumericType)
    text = F.col(name).cast("string")
    value = F.col(name) if number else text
    counted = F.col(name).cast("long") if isinstance(kind, IntegralType) else text
    real = F.col(name).cast("double")
    return [
        F.count_if(F.col(name).isNull()).alias(f"nulls_{i}"),
        F.min(value).cast("string").alias(f"low_{i}"),
        F.max(value).cast("string").alias(f"high_{i}"),
        (F.sum(real) if number else F.lit(None).cast("double")).alias(f"total_{i}"),
        F.hll_sketch_agg(counted, lg).alias(f"distinct_sketch_{i}"),
        (F.kll_sketch_agg_double(real, k) if number else F.lit(None).cast("binary")).alias(f"quantile_sketch_{i}"),
    ]


def merge_windows(sketches: DataFrame, window: str) -> DataFrame:
    """The same per longer windows, from the sketches alone.

    A merged window gathers as many small rows as it has short windows.
    """
    at = F.window(F.col("window_start").cast(TS), window)["start"].alias("window_start")
    number = F.col("total").isNotNull() | F.col("quantile_sketch").isNotNull()

    def extreme(best, name: str) -> Column:
        # Numbers by size, texts as they are.
        by = F.struct(F.when(number, F.col(name).try_cast("decimal(38,10)")), F.when(number, F.col(name).try_cast("double")), F.col(name).alias("text"))
        return best(F.when(F.col(name).isNotNull(), by))["text"].alias(name)

    merged = F.reduce(
        F.collect_list("quantile_sketch"), F.lit(None).cast("binary"),
        lambda a, b: F.when(a.isNull(), b).otherwise(F.kll_sketch_merge_double(a, b)),
    )
    return sketches.groupBy(at, "column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), extreme(F.min, "min_value"), extreme(F.max, "max_value"),
        F.sum("total").alias("total"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), merged.alias("quantile_sketch"),
    )


def sketch_metrics(sketches: DataFrame) -> DataFrame:
    """What sketches say: distinct values, extremes, mean and quantiles per window and column."""
    held = F.col("quantile_sketch").isNotNull()
    filled = F.when(held, F.kll_sketch_get_n_double("quantile_sketch")) > 0
    quantiles = [
        F.when(filled, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q))).alias(name) for name, q in QUANTILES.items()
    ]
    return sketches.select(
        "window_start", "column_name", "rows", "nulls", F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        "min_value", "max_value", F.try_divide(F.col("total"), F.col("rows") - F.col("nulls")).alias("mean_value"), *quantiles,
    )
