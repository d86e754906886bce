"""The disruption summary kept up to date by signed changes of journeys.

``DISRUPTION_COUNTS`` holds, per group of the summary, station and detail, how many journeys there
are, and each extreme time with the number of journeys that have it. A changed journey is taken away as
it was and added as it is. Numbers are additive; an extreme stays known while a journey that has it is
left. Only where the last one has gone are the counts of that station and detail made anew from
journeys. The stations with journeys are a multiset: a station counts as long as one of its rows does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.operators.gold import SUMMARY_KEYS, summary_of_stations
from linepulse.scratch import staged
from linepulse.tables import DISRUPTION_COUNTS

SIGN = "_sign"
KEYS = [*SUMMARY_KEYS, "home_station", "disruption_description"]
#: Name of each extreme: the journeys' time behind it, and whether it is the greatest.
EXTREMES = {"newest": ("_updated_at", True), "oldest": ("_updated_at", False), "inserted": ("_inserted_at", False)}


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    """Equal keys, nulls too."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def only(df: DataFrame, keys: DataFrame, names: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_anti``: is not) among ``keys``, nulls being equal."""
    return df.alias("d").join(keys.select(*names).distinct().alias("k"), _same(names, "d", "k"), how)


def dated(journeys: DataFrame) -> DataFrame:
    return journeys.withColumn("disruption_date", F.to_date("_updated_at"))


def signed(changes: DataFrame) -> DataFrame:
    """``changes(_old, _new)`` as journeys with a sign: the old one goes, the new one comes."""
    both = F.array(
        F.struct(F.lit(-1).alias(SIGN), F.col("_old").alias("row")), F.struct(F.lit(1).alias(SIGN), F.col("_new").alias("row"))
    )
    return changes.select(F.inline(both)).where("row IS NOT NULL").select(SIGN, "row.*")


def _by_time(images: DataFrame) -> DataFrame:
    """How many images of each sign a key has per time; equal times meet within tasks first."""
    times = F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).alias("time")) for c in ("_updated_at", "_inserted_at")])
    return (
        dated(images)
        .select(*KEYS, SIGN, F.col("customer_id").isNotNull().cast("int").alias("real"), F.inline(times))
        .groupBy(*KEYS, "of", "time")
        .agg(
            F.count_if(F.col(SIGN) > 0).alias("came"),
            F.count_if(F.col(SIGN) < 0).alias("went"),
            F.sum(F.col(SIGN) * F.col("real")).alias("customers"),
        )
    )


def _after(counts: DataFrame, images: DataFrame) -> DataFrame:
    """Counts of the images' keys after them, and whether an extreme has lost its last journey."""
    met = _by_time(images).alias("i").join(counts.alias("c"), _same(KEYS, "i", "c"), "left")
    once = F.col("i.of") == "_updated_at"
    aggregates = [
        F.sum(F.when(once, F.col("i.came") - F.col("i.went"))).alias("journeys"),
        F.sum(F.when(once, F.col("i.customers"))).alias("customers"),
        F.first(F.struct("c.*")).alias("old"),
    ]
    for name, (time, greatest) in EXTREMES.items():
        mine = (F.col("i.of") == time) & F.col("i.time").isNotNull()
        best = F.max if greatest else F.min
        aggregates += [
            best(F.when(mine & (F.col("i.came") > 0), F.struct("i.time", "i.came"))).alias(f"{name}_came"),
            F.sum(F.when(mine & (F.col("i.time") == F.col(f"c.{name}")), F.col("i.went"))).alias(f"{name}_went"),
        ]
    moved = met.groupBy(*[F.col(f"i.{k}").alias(k) for k in KEYS]).agg(*aggregates)
    columns = [
        (F.coalesce(F.col("old.journeys"), F.lit(0)) + F.col("journeys")).alias("journeys"),
        (F.coalesce(F.col("old.customers"), F.lit(0)) + F.col("customers")).alias("customers"),
    ]
    lost = F.lit(False)
    for name, (_, greatest) in EXTREMES.items():
        old, came = F.col(f"old.{name}"), F.col(f"{name}_came.time")
        left = F.col(f"old.{name}_journeys") - F.coalesce(F.col(f"{name}_went"), F.lit(0))
        beats = old.isNull() | (came > old if greatest else came < old)
        n = F.when(beats, F.col(f"{name}_came.came")).when(came == old, left + F.col(f"{name}_came.came")).otherwise(left)
        columns += [F.when(beats & came.isNotNull(), came).otherwise(old).alias(name), n.alias(f"{name}_journeys")]
        lost = lost | F.coalesce(n <= 0, F.lit(False))
    rows = moved.select(*KEYS, *columns, lost.alias("lost"))
    return rows.where("journeys > 0")


def station_counts(journeys: DataFrame) -> DataFrame:
    """The counts of all journeys."""
    none = journeys.sparkSession.createDataFrame([], ", ".join(f"{n} {k}" for n, k, _ in DISRUPTION_COUNTS.columns))
    images = journeys.withColumn(SIGN, F.lit(1))
    return _after(none, images).select(DISRUPTION_COUNTS.column_names)


@contextmanager
def counts_after(counts: DataFrame, images: DataFrame, journeys: DataFrame) -> Iterator[DataFrame]:
    """``counts`` after signed ``images``, for the block; ``journeys`` are those after them.

    Journeys are read only where an extreme is lost. ``counts`` has to hold at least the rows of the
    images' keys; the others are given back as they are.
    """
    names = DISRUPTION_COUNTS.column_names
    with staged(_after(counts, images), "counts") as after:
        gone = after.where("lost")
        parts = [only(counts, dated(images), KEYS, "left_anti"), after.where("NOT lost")]
        if not gone.isEmpty():
            parts.append(station_counts(only(dated(journeys), gone, KEYS)))
        yield reduce(DataFrame.unionByName, [p.select(names) for p in parts])


def summary_of_counts(counts: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The summary of the journeys behind the counts: equal to ``disruption_summary`` of them."""
    rows = counts.select(*KEYS, "customers", "newest", "inserted", F.col("oldest").alias("updated"))
    return summary_of_stations(rows, as_of)
