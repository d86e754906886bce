"""Keyed tables fed by a stream: a log of upserted rows, and the state it gives.

A micro-batch writes the rows it upserts to a folder of its own. A batch that is
run again overwrites its folder, so nothing counts twice. The state is the latest
row per key over the log, whatever order rows arrived in. ``fold`` writes it out, and
removes what is folded and what every stream that reads the log has read. All of it sits below one
root, the stream's checkpoint too: batch numbers start anew only together with the log.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from linepulse.operators.upsert import scd1
from linepulse.scratch import folders, is_complete, make_dir, remove

BATCH = "batch_id"


class ReaderBehind(RuntimeError):
    """A stream has not read all of a log that is to be purged."""


def log_path(root: str) -> str:
    return f"{root}/log"


def upsert_stream(
    source: DataFrame,
    root: str,
    rows_of: Callable[[DataFrame], AbstractContextManager[DataFrame]],
    reads: str | None = None,
) -> StreamingQuery:
    """Start a stream that writes ``rows_of(batch)`` to the log and ends when caught up.

    ``rows_of`` should give each key once, which keeps the log short. ``reads`` is the root of the log
    that is the source: how far it was read is noted there once a batch is written.
    """
    spark = source.sparkSession
    open_log(spark, root)
    if reads:
        _note(spark, reads, root, -1)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The write itself tells how far the batch goes; a batch read once more costs as much again.
        seen = Observation(f"read-{uuid.uuid4().hex}")
        if reads:
            batch = batch.observe(seen, F.max(BATCH).alias("newest"))
        with rows_of(batch) as rows:
            rows.write.mode("overwrite").parquet(f"{log_path(root)}/{BATCH}={batch_id}")
        if reads and (newest := seen.get.get("newest")) is not None:
            _note(spark, reads, root, newest)

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def open_log(spark: SparkSession, root: str) -> None:
    """Make an empty log if there is none; readers and streams may start before the first batch."""
    make_dir(spark, log_path(root))


def stream_log(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The log as a stream of changes, with the batch they came in.

    A batch that was run again replaces its files, so a listed file may be gone;
    its rows come with the new file.
    """
    return (
        spark.readStream.schema(StructType([*schema.fields]).add(BATCH, "long"))
        .option("ignoreMissingFiles", "true")
        .parquet(log_path(root))
    )


def _note(spark: SparkSession, root: str, reader: str, position: int) -> None:
    """The reader has written all of a batch's rows up to this one, which may still be growing."""
    make_dir(spark, f"{root}/readers/{hashlib.md5(reader.encode()).hexdigest()}/{position}")


def positions(spark: SparkSession, root: str) -> list[int]:
    """The newest batch that each reader of a log has read from; all before it are read whole."""
    return [
        max(int(p) for p in folders(spark, f"{root}/readers/{reader}")) for reader in folders(spark, f"{root}/readers")
    ]


def _batches(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(f.split("=")[1]) for f in folders(spark, log_path(root)) if f.startswith(BATCH))


def _states(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """Last batch and revision of each state that was written to its end, in order."""
    found = [f for f in folders(spark, f"{root}/state") if is_complete(spark, f"{root}/state/{f}")]
    return sorted(tuple(map(int, f.split("=")[1].split("-"))) for f in found)


def _state_path(root: str, state: tuple[int, int]) -> str:
    return f"{root}/state/upto={state[0]}-{state[1]}"


def _versions(spark: SparkSession, root: str, schema: StructType, upto: int | None = None) -> DataFrame:
    """The newest state, and the log folders behind it."""
    states = _states(spark, root)
    after = states[-1][0] if states else -1
    paths = [f"{log_path(root)}/{BATCH}={b}" for b in _batches(spark, root) if b > after and (upto is None or b <= upto)]
    paths += [_state_path(root, s) for s in states[-1:]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _latest(rows: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The latest row per key of log and state. A batch has each key once, so tasks that read them have
    nothing to drop before the shuffle, and need not sort."""
    return scd1(rows.repartition(*keys), keys, sequence_by)


def current_rows(
    spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], sequence_by: Sequence[str]
) -> DataFrame:
    """The latest row per key: the last fold, and only the log folders after it."""
    return _latest(_versions(spark, root, schema), keys, sequence_by)


def fold(
    spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], sequence_by: Sequence[str]
) -> int:
    """Write the state of all finished batches, and remove what nobody needs any more.

    The newest batch may still be run again, so it stays in the log, and so does what a reader has not
    read; a log that nothing reads keeps its folders for a reader to come. Returns the last folded batch.
    """
    states, batches = _states(spark, root), _batches(spark, root)
    done = states[-1][0] if states else -1
    if batches and batches[-1] - 1 > done:
        done = batches[-1] - 1
        rows = _latest(_versions(spark, root, schema, done), keys, sequence_by)
        rows.write.mode("overwrite").parquet(_state_path(root, (done, 0)))
    read = min(positions(spark, root), default=-1)
    _remove(spark, root, [b for b in batches if b <= done and b < read], states[:-1])
    return done


def _remove(spark: SparkSession, root: str, batches: list[int], states: list[tuple[int, int]]) -> None:
    for batch in batches:
        remove(spark, f"{log_path(root)}/{BATCH}={batch}")
    for state in states:
        remove(spark, _state_path(root, state))


def purge(
    spark: SparkSession,
    root: str,
    schema: StructType,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    kept: Callable[[DataFrame], DataFrame],
) -> None:
    """Leave only ``kept`` rows in log and state, and no folder that is folded.

    Call it while neither this stream nor one that reads its log is running. It refuses with
    ``ReaderBehind`` while a reader has rows of the log to read. Batches keep their numbers.
    """
    states, batches = _states(spark, root), _batches(spark, root)
    if batches and min(positions(spark, root), default=batches[-1]) < batches[-1]:
        raise ReaderBehind(f"let the streams that read {log_path(root)} catch up first")
    if not states and not batches:
        return
    done, revision = states[-1] if states else (-1, 0)
    new = (batches[-1], 0) if batches and batches[-1] > done else (done, revision + 1)
    rows = kept(_latest(_versions(spark, root, schema), keys, sequence_by))
    rows.write.mode("overwrite").parquet(_state_path(root, new))
    _remove(spark, root, batches, states)
