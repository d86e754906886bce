"""How the distribution of a column changes from one window to the next.

Numbers are counted in bins whose edges the window before has fixed: equal parts of its range, one bin
below and one above it. Categories are counted by value. Rows are counted in their tasks first, so a hot
day or value is a few partial counts; what is shuffled are bins and categories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepulse.fixed import TS

BINS = 10
#: Added to each bin's count, so that an empty bin has a finite share in the stability index.
SMOOTHING = 0.5
#: Measures are given to so many places.
PLACES = 6


def distribution_drift(
    df: DataFrame,
    ts_col: str,
    numbers: Sequence[str] = (),
    categories: Sequence[str] = (),
    window: str = "1 day",
    bins: int = BINS,
) -> DataFrame:
    """One row per column and window that has one before it: how far it is from that one.

    ``stability_index`` is the population stability index and ``ks_distance`` the greatest difference of
    the cumulative shares at the edges, both of numbers; ``js_divergence`` is the Jensen-Shannon
    divergence in bits, from 0 to 1, of categories. Nulls are no value; a window in which a column has
    none is passed over, so the window before it is that with a value.
    """
    at = F.window(F.col(ts_col).cast(TS), window)["start"].alias("window_start")
    rows = df.withColumn("window_start", at).where("window_start IS NOT NULL")
    parts = []
    if numbers:
        parts.append(_numbers(_cells(rows, numbers, "double"), bins))
    if categories:
        parts.append(_categories(_cells(rows, categories, "string")))
    if not parts:
        raise ValueError("name a column")
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return found.select(
        "column_name", "window_start", "previous_window",
        *[F.round(c, PLACES).alias(c) for c in ("stability_index", "ks_distance", "js_divergence")],
    )


def _cells(rows: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value")) for c in columns]
    return rows.select("window_start", F.inline(F.array(*cells))).where("value IS NOT NULL")


def _both(counts: DataFrame, windows: DataFrame, also: Sequence[str]) -> DataFrame:
    """Counts as those of their own window, and again as the window before of the next one."""
    order = Window.partitionBy("column_name").orderBy("window_start")
    steps = windows.select("column_name", "window_start", F.lead("window_start").over(order).alias("next_window"))
    met = counts.join(steps, ["column_name", "window_start"])
    return met.select(
        "column_name", *also, "n",
        F.inline(F.array(
            F.struct(F.col("window_start").alias("window"), F.lit(1).alias("now"), F.lit(None).cast(TS).alias("previous_window")),
            F.struct(F.col("next_window").alias("window"), F.lit(0).alias("now"), F.col("window_start").alias("previous_window")),
        )),
    ).where("window IS NOT NULL")


def _numbers(cells: DataFrame, bins: int) -> DataFrame:
    order = Window.partitionBy("column_name").orderBy("window_start")
    # One row per column and window.
    ranges = cells.groupBy("column_name", "window_start").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    edges = ranges.select(
        "column_name", "window_start", "low", "high",
        F.lag("window_start").over(order).alias("previous_window"), F.lag("low").over(order).alias("before_low"),
        F.lag("high").over(order).alias("before_high"), F.lead("window_start").over(order).alias("next_window"),
    )
    binned = (
        cells.join(edges, ["column_name", "window_start"])
        .select(
            "column_name",
            F.inline(F.array(
                F.struct(F.when(F.col("previous_window").isNotNull(), F.col("window_start")).alias("window"), F.lit(1).alias("now"),
                         F.col("previous_window"), _bin("before_low", "before_high", bins).alias("bin")),
                F.struct(F.col("next_window").alias("window"), F.lit(0).alias("now"),
                         F.col("window_start").alias("previous_window"), _bin("low", "high", bins).alias("bin")),
            )),
        )
        .where("window IS NOT NULL")
        .groupBy("column_name", "window", "previous_window", "bin")
        .agg(F.sum("now").alias("now"), F.sum(1 - F.col("now")).alias("before"))
    )
    # A bin that neither window has adds nothing but its share of the smoothing.
    key = ["column_name", "window", "previous_window"]
    grid = binned.groupBy(*key).agg(F.sum("now").alias("all_now"), F.sum("before").alias("all_before"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins + 1))).alias("bin"))
    full = grid.join(binned, [*key, "bin"], "left").na.fill(0, ["now", "before"])
    upto = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    size = SMOOTHING * (bins + 2)
    p, q = ((F.col(n) + SMOOTHING) / (F.col(f"all_{n}") + size) for n in ("now", "before"))
    apart = F.sum("now").over(upto) / F.col("all_now") - F.sum("before").over(upto) / F.col("all_before")
    return (
        full.select(*key, ((p - q) * F.ln(p / q)).alias("index"), F.abs(apart).alias("apart"))
        .groupBy(*key)
        .agg(F.sum("index").alias("stability_index"), F.max("apart").alias("ks_distance"))
        .select(
            "column_name", F.col("window").alias("window_start"), "previous_window", "stability_index", "ks_distance",
            F.lit(None).cast("double").alias("js_divergence"),
        )
    )


def _bin(low: str, high: str, bins: int) -> Column:
    """0 below the range, ``bins`` + 1 above it, and its equal parts between; a single value is part 1."""
    value, width = F.col("value"), F.col(high) - F.col(low)
    part = F.least(F.lit(bins - 1), F.floor((value - F.col(low)) / width * bins)) + 1
    return (
        F.when(value < F.col(low), 0).when(value > F.col(high), bins + 1).when(width > 0, part).otherwise(1).cast("int")
    )


def _categories(cells: DataFrame) -> DataFrame:
    counts = cells.groupBy("column_name", "window_start", "value").agg(F.count(F.lit(1)).alias("n"))
    windows = counts.groupBy("column_name", "window_start").agg(F.sum("n").alias("all"))
    both = _both(counts, windows, ["value"])
    key = ["column_name", "window"]
    per_value = both.groupBy(*key, "value").agg(
        F.sum(F.col("n") * F.col("now")).alias("now"), F.sum(F.col("n") * (1 - F.col("now"))).alias("before"),
        F.max("previous_window").alias("previous_window"),
    )
    # Totals from partial sums: a column with many values is no single group of rows.
    totals = per_value.groupBy(*key).agg(
        F.sum("now").alias("all_now"), F.sum("before").alias("all_before"), F.max("previous_window").alias("previous"),
    )
    p, q = (F.col(n) / F.col(f"all_{n}") for n in ("now", "before"))
    m = (p + q) / 2

    def bits(share: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / m)).otherwise(0.0)

    return (
        per_value.drop("previous_window").join(totals.where("all_before > 0"), key)
        .groupBy(*key, "previous")
        .agg(F.sum((bits(p) + bits(q)) / 2).alias("js_divergence"))
        .select(
            "column_name", F.col("window").alias("window_start"), F.col("previous").alias("previous_window"),
            F.lit(None).cast("double").alias("stability_index"), F.lit(None).cast("double").alias("ks_distance"), "js_divergence",
        )
    )
