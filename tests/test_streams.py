"""Streams give what the batch gives, in any order of files, and survive a batch run twice."""

import random
from contextlib import contextmanager
from pathlib import Path

import pytest
from conftest import SF, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from linepulse.operators import gold
from linepulse.operators.journeys import customer_journeys, journey_versions
from linepulse.plans import registry
from linepulse.scratch import make_dir, shared_dir
from linepulse.sources import adapter
from linepulse.sources.adapter import AS_OF
from linepulse.streaming import changelog, flows
from linepulse.streaming.changelog import log_path


def write_files(spark, folder, parts=5, seed=7):
    """Status rows in several files, out of time order."""
    status = adapter.status(spark, SF)
    order = list(range(parts))
    random.Random(seed).shuffle(order)
    sliced = status.withColumn("part", F.ntile(parts).over(Window.orderBy("_updated_at")) - 1)
    for part in order:
        sliced.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)
    return status


@pytest.fixture
def world(spark, tmp_path):
    folder = str(tmp_path / "status")
    status = write_files(spark, folder)
    return folder, status, adapter.profiles(spark, SF), str(tmp_path / "silver"), str(tmp_path / "gold")


def run(spark, folder, status, people, root, files=1):
    stream = flows.scan_stream(spark, folder, status.schema, files_per_batch=files)
    flows.stream_journeys(stream, lambda: people, root, AS_OF).awaitTermination()


def test_streams_equal_the_batch(spark, world):
    folder, status, people, silver, gold_root = world
    run(spark, folder, status, people, silver)
    wanted = customer_journeys(people, status, AS_OF)
    assert rows(flows.current_journeys(spark, silver)) == rows(wanted)
    flows.stream_notifications(spark, silver, gold_root, AS_OF).awaitTermination()
    targets = rows(gold.notification_targets(wanted, AS_OF))
    assert rows(flows.current_targets(spark, gold_root)) == targets
    flows.fold_targets(spark, gold_root)
    assert rows(flows.current_targets(spark, gold_root)) == targets


def test_fold_keeps_the_state_and_the_stream_goes_on(spark, world):
    folder, status, people, silver, _ = world
    run(spark, folder, status, people, silver)
    before = rows(flows.current_journeys(spark, silver))
    assert flows.fold_journeys(spark, silver) == 3
    assert flows.fold_journeys(spark, silver) == 3
    assert rows(flows.current_journeys(spark, silver)) == before
    more = status.withColumn("_updated_at", F.col("_updated_at") + F.expr("interval 40 days"))
    more.coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, status, people, silver)
    wanted = customer_journeys(people, status.unionByName(more), AS_OF)
    assert rows(flows.current_journeys(spark, silver)) == rows(wanted)
    assert flows.fold_journeys(spark, silver) == 4
    assert rows(flows.current_journeys(spark, silver)) == rows(wanted)


def test_a_batch_run_again_changes_nothing(spark, world):
    folder, status, people, silver, gold_root = world
    run(spark, folder, status, people, silver, files=2)
    before = rows(flows.current_journeys(spark, silver))
    flows.stream_notifications(spark, silver, gold_root, AS_OF).awaitTermination()
    targets = rows(flows.current_targets(spark, gold_root))
    again = journey_versions(people, status, AS_OF).select(flows.JOURNEYS.names)
    again.write.mode("overwrite").parquet(f"{log_path(silver)}/batch_id=2")
    assert rows(flows.current_journeys(spark, silver)) == before
    flows.stream_notifications(spark, silver, gold_root, AS_OF).awaitTermination()
    assert rows(flows.current_targets(spark, gold_root)) == targets


def test_profiles_are_read_anew_for_each_batch(spark, world):
    folder, status, people, silver, _ = world
    run(spark, folder, status, people.filter("customer_id < '2'"), silver)
    late = people.filter("customer_id >= '2'")
    status.coalesce(1).write.mode("append").parquet(folder)
    run(spark, folder, status, late, silver)
    assert rows(flows.current_journeys(spark, silver)) == rows(customer_journeys(people, status, AS_OF))


def test_a_table_in_a_folder_streams_through_the_glob(spark, tmp_path):
    status = adapter.status(spark, SF)
    status.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    stream = flows.scan_stream(spark, adapter.glob_of(str(tmp_path), "events"), status.schema)
    out = str(tmp_path / "out")
    stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start(out, format="parquet").awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(status)


def small_log(spark, root, batch, keys):
    """A finished batch of the journeys' log."""
    rows = journey_versions(adapter.profiles(spark, SF).where(F.col("customer_id").isin(keys)), adapter.status(spark, SF), AS_OF)
    rows.select(flows.JOURNEYS.names).coalesce(1).write.mode("overwrite").parquet(f"{log_path(root)}/batch_id={batch}")


def test_the_log_holds_what_is_unread_and_the_newest(spark, tmp_path):
    silver, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    changelog.open_log(spark, silver)
    small_log(spark, silver, 0, ["1", "2", "4"])
    files = list((tmp_path / "silver" / "log" / "batch_id=0").glob("*.parquet"))

    def more(first, last):
        for i in range(first, last):
            folder = tmp_path / "silver" / "log" / f"batch_id={i}"
            folder.mkdir()
            for f in files:
                (folder / f.name).write_bytes(f.read_bytes())

    more(1, 100)
    assert flows.fold_journeys(spark, silver) == 98
    assert len(changelog.folders(spark, log_path(silver))) == 100  # nobody reads it yet
    flows.stream_notifications(spark, silver, gold_root, AS_OF).awaitTermination()
    assert changelog.positions(spark, silver) == [99]
    more(100, 200)
    assert flows.fold_journeys(spark, silver) == 198
    left = sorted(int(f.split("=")[1]) for f in changelog.folders(spark, log_path(silver)))
    assert left == list(range(99, 200))  # the reader is at 99
    with pytest.raises(changelog.ReaderBehind):
        flows.purge_journeys(spark, silver, "2024-06-01 00:00:00")
    flows.stream_notifications(spark, silver, gold_root, AS_OF).awaitTermination()
    assert flows.fold_journeys(spark, silver) == 198
    assert changelog.folders(spark, log_path(silver)) == ["batch_id=199"]
    assert len(changelog.folders(spark, f"{silver}/state")) == 1
    wanted = rows(flows.current_journeys(spark, silver))
    assert wanted
    flows.purge_journeys(spark, silver, "2024-06-01 00:00:00")
    flows.purge_journeys(spark, silver, "2024-06-01 00:00:00")
    assert rows(flows.current_journeys(spark, silver)) == wanted
    assert changelog.folders(spark, log_path(silver)) == []


def test_a_state_that_was_not_written_to_its_end_does_not_count(spark, world):
    folder, status, people, silver, _ = world
    run(spark, folder, status, people, silver)
    wanted = rows(flows.current_journeys(spark, silver))
    make_dir(spark, f"{silver}/state/upto=9-0")
    assert rows(flows.current_journeys(spark, silver)) == wanted
    with pytest.raises(Exception, match="boom"):
        changelog.purge(spark, silver, flows.JOURNEYS, flows.KEYS, flows.SEQUENCE, lambda df: df.where(F.raise_error(F.lit("boom")).cast("boolean")))
    assert rows(flows.current_journeys(spark, silver)) == wanted


def test_streams_leave_no_staged_rows(spark, world):
    folder, status, people, silver, gold_root = world
    place = f"{shared_dir(spark)}/linepulse"
    before = set(changelog.folders(spark, place))
    run(spark, folder, status, people, silver)
    flows.stream_notifications(spark, silver, gold_root, AS_OF).awaitTermination()
    assert set(changelog.folders(spark, place)) <= before


def test_a_reader_reads_a_batch_once(spark, world, tmp_path):
    folder, status, people, silver, _ = world
    run(spark, folder, status, people, silver)
    in_log = spark.read.schema(flows.JOURNEYS).parquet(log_path(silver)).count()
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    @contextmanager
    def rows_of(batch):
        yield batch.select(flows.JOURNEYS.names)

    source = changelog.stream_log(spark, silver, flows.JOURNEYS).withColumn("full_name", counted("full_name"))
    changelog.upsert_stream(source, str(tmp_path / "reader"), rows_of, reads=silver).awaitTermination()
    assert seen.value == in_log > 0
    assert changelog.positions(spark, silver) == [4]


def test_rows_of_the_log_are_sorted_only_after_the_shuffle(spark, world, capsys):
    folder, status, people, silver, _ = world
    run(spark, folder, status, people, silver)
    flows.current_journeys(spark, silver).explain()
    plan = capsys.readouterr().out
    assert plan.index("Exchange") > plan.rindex("Sort")
    assert "Partial" not in plan


def test_a_batch_of_many_events_has_several_files(spark, monkeypatch):
    wanted = rows(registry.QUERIES["stream_journeys"](spark, SF))
    monkeypatch.setattr(registry, "LANDED_ROWS", 100)
    taken = []
    scan = flows.scan_stream
    monkeypatch.setattr(flows, "scan_stream", lambda *a, **k: (taken.append((len(list(Path(a[1]).glob("*.parquet"))), k)), scan(*a, **k))[1])
    assert rows(registry.QUERIES["stream_journeys"](spark, SF)) == wanted
    files, options = taken[0]
    assert files == 12 and options == {"files_per_batch": 4}
