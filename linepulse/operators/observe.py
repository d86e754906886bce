"""Profile of a table per day, and how it drifts from one day to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from linepulse.fixed import TS

# The monitor's own metrics are not described anywhere; these are our choice.


def profile_metrics(
    df: DataFrame, ts_col: str, columns: Sequence[str], window: str = "1 day"
) -> DataFrame:
    """Metrics of each column per time window: rows, nulls, distinct values, extremes, mean.

    Each row is turned into one cell per column, and equal cells of a window are
    counted first, within tasks and then across them. What is left are distinct
    values, however many rows a value or a window has. Extremes of numbers go by
    size, those of other types by text; only numbers have a mean.
    """
    cells = df.select(
        F.window(F.col(ts_col).cast(TS), window)["start"].alias("window_start"),
        F.inline(F.array(*[_cell(df, c) for c in columns])),
    )
    values = cells.groupBy("window_start", "column_name", "value", "whole", "real").agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = F.when(F.col("value").isNotNull(), F.struct("whole", "real", "value"))
    numbers = F.sum(F.when(F.col("real").isNotNull(), F.col("n")))
    return (
        values.groupBy("window_start", "column_name")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
            F.min(ranked)["value"].alias("min_value"),
            F.max(ranked)["value"].alias("max_value"),
            F.try_divide(F.sum(F.col("real") * F.col("n")), numbers).alias("mean_value"),
        )
    )


def _cell(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    whole = F.col(column) if isinstance(kind, IntegralType) else F.lit(None)
    real = F.col(column) if isinstance(kind, NumericType) else F.lit(None)
    return F.struct(
        F.lit(column).alias("column_name"),
        F.col(column).cast("string").alias("value"),
        whole.cast("long").alias("whole"),
        real.cast("double").alias("real"),
    )


def drift_metrics(profile: DataFrame) -> DataFrame:
    """Change of each column's metrics against its window before.

    A profile has one row per window and column, so a column's history is short.
    """
    before = Window.partitionBy("column_name").orderBy("window_start")
    null_share = F.try_divide(F.col("nulls"), F.col("rows"))

    def change(metric):
        return metric - F.lag(metric).over(before)

    return profile.select(
        "column_name",
        "window_start",
        F.lag("window_start").over(before).alias("previous_window"),
        change(F.col("rows")).alias("rows_change"),
        change(null_share).alias("null_share_change"),
        change(F.col("distinct_values")).alias("distinct_change"),
        change(F.col("mean_value")).alias("mean_change"),
    ).filter(F.col("previous_window").isNotNull())
