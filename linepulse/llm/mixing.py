"""Mixing sources to target weights, at word level.

Every document has a key that is as good as random, the hash of its id and text. The keys are
dealt over ranges of equal width within each source, sums are taken per range, and a running sum
over the ranges finds the one that holds the end of the source's budget. Only that range is
sorted and summed row by row. So a source of any size is cut exactly, no range holds more than
about ``RANGE_ROWS`` documents, and a document is taken or not by comparing its key.

A source whose target is above its size is taken whole as often as it fits, and the rest is cut
from one more pass. The document at the cut gives the words that are left; rows that tie, exact
repeats of id and text, share them. Null texts have no words; a null source is a source, and the
last in order. A source without words has target zero. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepulse.llm.common import free_name, word_count
from linepulse.scratch import stage

WEIGHTS = (1, 2, 3)
EPOCHS = 3
RANGE_ROWS = 1024
_HEX = 12
_SPAN = 16.0**_HEX


def mix_key(doc_id: Column, text: Column) -> Column:
    """Hash-random key of a row, the same in every run: 32 hex digits."""
    return F.md5(F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))


def targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``sources(source, weight, source_size)`` with ``target``.

    All sizes are shared by weight. A source gets at most ``epochs`` times its size; what is above
    goes to the others by weight, until none is above. In order of size to weight the capped
    sources come first, so running sums find the share of the rest. One row per source is sorted.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shared = sources.withColumns(
        {
            "rest_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "rest_size": F.sum("source_size").over(everything)
            - epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        }
    )
    # The share per unit of weight if all before are capped, and this one and those after are not.
    shared = shared.withColumn("share", F.col("rest_size") / F.col("rest_weight"))
    shared = shared.withColumn("capped", epochs * F.col("source_size") < F.col("share") * F.col("weight"))
    first_free = F.first(F.when(~F.col("capped"), F.col("share")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return shared.withColumn("free", first_free).select(
        "source",
        "weight",
        "source_size",
        F.when(F.col("capped"), epochs * F.col("source_size").cast("double"))
        .otherwise(F.coalesce(F.col("free") * F.col("weight"), F.lit(0.0)))
        .alias("target"),
    )


def by_rank(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The weights in turn over the sources in code-point order, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array([F.lit(w) for w in weights])
    return sources.withColumn("weight", F.element_at(cycle, F.pmod(rank, F.lit(len(weights))) + 1).cast("long"))


def cuts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per source: its target, whole passes, and the key and words of the row at the cut.

    ``cut_key`` is null where the last pass is empty. Rows of smaller keys are taken whole in it,
    the row of that key with ``cut_words``.
    """
    rows = stage(
        docs.select("source", mix_key(F.col("doc_id"), F.col("text")).alias("key"), word_count(F.col("text")).alias("size")),
        "sizes",
    )
    summed = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    summed = stage(summed, "sources")
    goals = targets(by_rank(summed.drop("n"), weights), epochs).withColumnRenamed("source", "of")
    goals = summed.join(goals.drop("source_size"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    size = F.greatest(F.col("source_size"), F.lit(1))
    # A target that is a whole multiple of the size is all passes and no cut.
    goals = goals.withColumn("passes", F.floor(F.col("target") / size))
    goals = stage(goals.withColumn("left", F.floor(F.col("target")) - F.col("passes") * F.col("source_size")), "targets")

    parts = goals.select(
        F.col("source").alias("of"), F.ceil(F.col("n") / range_rows).alias("ranges"), F.col("left").alias("budget")
    )
    place = F.conv(F.substring("key", 1, _HEX), 16, 10).cast("double") / _SPAN
    ranged = rows.join(parts, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "range", F.floor(place * F.col("ranges"))
    )
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("range")) - F.col("words")
    held = (
        sums.withColumn("start", running)
        .where("start < budget AND budget <= start + words")
        .select(F.col("source").alias("in"), F.col("range").alias("held"), "start")
    )
    inside = ranged.join(held, F.col("source").eqNullSafe(F.col("in")) & (F.col("range") == F.col("held")))
    tied = inside.groupBy("source", "key").agg(
        F.sum("size").alias("words"), F.count("*").alias("ties"), F.first("start").alias("start"), F.first("budget").alias("budget")
    )
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("key"))
    cut = (
        tied.withColumn("upto", F.col("start") + upto)
        .where("upto - words < budget AND budget <= upto")
        .select(
            F.col("source").alias("in"),
            F.col("key").alias("cut_key"),
            F.floor((F.col("budget") - F.col("upto") + F.col("words")) / F.col("ties")).alias("cut_words"),
        )
    )
    return stage(
        goals.join(cut, F.col("source").eqNullSafe(F.col("in")), "left").select(
            "source", "source_size", "target", "passes", "cut_key", "cut_words"
        ),
        "cuts",
    )


def taken(size: Column, key: Column) -> Column:
    """Words that the mix takes of a row, over all passes, beside the columns of :func:`cuts`."""
    last = F.when(key < F.col("cut_key"), size).when(key == F.col("cut_key"), F.col("cut_words")).otherwise(F.lit(0))
    return F.col("passes") * size + last


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for each row of ``docs(doc_id, source, text)``."""
    found = cuts(docs, weights, epochs).withColumnRenamed("source", "of")
    rows = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), mix_key(F.col("doc_id"), F.col("text")).alias("key")
    )
    return rows.join(found, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", taken(F.col("size"), F.col("key")).alias("taken")
    )


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns and whole texts.

    The one row at a source's cut is taken once more if at least half of its words are: texts are
    never cut, so a source may be off its target by half of one document. Rows without words,
    which no budget counts, stay once.
    """
    names = [free_name(docs, x) for x in ("mix_of", "mix_size", "mix_key", "mix_times", "mix_copy")]
    of, size, key, times, copy = names
    found = cuts(docs, weights, epochs).withColumnRenamed("source", of)
    found = found.select(of, F.struct("passes", "cut_key", "cut_words").alias(times))
    text = F.col("text")
    rows = docs.withColumns({size: word_count(text), key: mix_key(F.col("doc_id"), text)})
    rows = rows.join(found, rows["source"].eqNullSafe(found[of]))
    last = (F.col(key) < F.col(times)["cut_key"]) | (
        (F.col(key) == F.col(times)["cut_key"]) & (2 * F.col(times)["cut_words"] >= F.col(size))
    )
    n = F.when(F.col(size) == 0, 1).otherwise(F.col(times)["passes"] + F.coalesce(last.cast("int"), F.lit(0)))
    rows = rows.withColumn(copy, F.explode(F.array_repeat(F.lit(0), n.cast("int"))))
    return rows.select(*[F.col(c) for c in docs.columns])
