"""Sketch profiles against exact ones, drift of distributions, and rules with reasons."""

import math
import uuid

import pytest
from conftest import SF, at, rows
from pyspark.sql import functions as F

from linepulse.operators import drift, quality, sketches
from linepulse.operators.journeys import profile_rules
from linepulse.operators.observe import profile_metrics
from linepulse.plans.registry import all_journeys
from linepulse.scratch import folders, shared_dir
from linepulse.sources import adapter
from linepulse.tables import CUSTOMER_JOURNEYS



@pytest.fixture(scope="module")
def days(spark):
    """Three days: 30,000 rows, a third of them of one value; the last day is shifted."""
    n = F.col("id")
    return spark.range(90_000).select(
        (F.lit("2024-05-01").cast("timestamp_ntz") + F.make_dt_interval(F.floor(n / 30_000).cast("int"))).alias("t"),
        F.when(n % 3 == 0, 0).otherwise(F.xxhash64("id") % 20_000).cast("long").alias("whole"),
        F.when(n % 11 != 0, (F.xxhash64("id") % 1000) / 1000 + F.when(n >= 60_000, 3).otherwise(0)).alias("real"),
        F.concat(F.lit("v"), (n % 7) * F.when(n >= 60_000, 1).otherwise(2)).alias("text"),
        F.lit(None).cast("double").alias("nothing"),
    )


def test_sketches_are_within_their_error(spark, days):
    columns = ["whole", "real", "text", "nothing"]
    exact = {(r.window_start, r.column_name): r for r in profile_metrics(days, "t", columns).collect()}
    got = sketches.sketch_metrics(sketches.profile_sketches(days, "t", columns)).collect()
    assert {(r.window_start, r.column_name) for r in got} == set(exact)
    for r in got:
        e = exact[r.window_start, r.column_name]
        assert (r.rows, r.nulls, r.min_value, r.max_value) == (e.rows, e.nulls, e.min_value, e.max_value)
        assert r.mean_value == pytest.approx(e.mean_value) if e.mean_value is not None else r.mean_value is None
        assert abs(r.distinct_values - e.distinct_values) <= 4 * 1.04 / math.sqrt(2**sketches.LG) * e.distinct_values
        if r.column_name in ("whole", "real"):
            day = days.where(F.col("t") == F.lit(r.window_start)).where(f"{r.column_name} IS NOT NULL")
            for name, q in sketches.QUANTILES.items():
                below, upto = day.select(
                    F.avg((F.col(r.column_name) < r[name]).cast("int")), F.avg((F.col(r.column_name) <= r[name]).cast("int"))
                ).first()
                assert below - 0.0165 <= q <= upto + 0.0165
        else:
            assert all(r[name] is None for name in sketches.QUANTILES)


def test_merged_windows_equal_one_long_window(spark, days):
    daily = sketches.profile_sketches(days, "t", ["whole", "real", "text", "nothing"])
    merged = sketches.sketch_metrics(sketches.merge_windows(daily, "30 days"))
    whole = sketches.sketch_metrics(sketches.profile_sketches(days, "t", ["whole", "real", "text", "nothing"], "30 days"))
    exact = ["window_start", "column_name", "rows", "nulls", "min_value", "max_value"]
    assert rows(merged.select(exact)) == rows(whole.select(exact))
    for a, b in zip(merged.orderBy("column_name").collect(), whole.orderBy("column_name").collect(), strict=True):
        assert a.distinct_values == pytest.approx(b.distinct_values, rel=0.03)
        assert a.p50 == pytest.approx(b.p50, rel=0.1) if a.p50 else a.p50 == b.p50


def test_only_sketches_are_shuffled(spark):
    df = sketches.profile_sketches(all_journeys(spark, SF), "_updated_at", CUSTOMER_JOURNEYS.column_names)
    plan = df._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("partial_hll")] if "partial_hll" in plan else plan
    assert above.count("Exchange") == 1
    assert df.count() == 19 * df.select("window_start").distinct().count()


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([(None, 1)], "t timestamp_ntz, x int")
    assert sketches.profile_sketches(empty, "t", ["x"]).count() == 0
    assert sketches.merge_windows(sketches.profile_sketches(empty, "t", ["x"]), "7 days").count() == 0


def test_drift_shows_a_planted_shift(spark, days):
    found = drift.distribution_drift(days, "t", ["whole", "real", "nothing"], ["text"])
    by = {(r.column_name, r.window_start.day): r for r in found.collect()}
    assert set(by) == {(c, d) for c in ("whole", "real", "text") for d in (2, 3)}
    for d in (2, 3):
        assert by["whole", d].previous_window == at(f"2024-05-0{d - 1}")
        assert by["whole", d].stability_index < 0.01 and by["whole", d].ks_distance < 0.02
    assert by["real", 2].stability_index < 0.01 and by["real", 2].ks_distance < 0.02
    assert by["real", 3].stability_index > 5 and by["real", 3].ks_distance == pytest.approx(1, abs=0.01)
    assert by["text", 2].js_divergence < 0.001
    assert by["text", 3].js_divergence > 0.3
    assert by["text", 3].stability_index is None and by["real", 3].js_divergence is None


def test_drift_of_single_values_and_missing_days(spark):
    data = [(f"2024-05-0{d}", x, c) for d, x, c in [(1, 5.0, "a"), (1, 5.0, "a"), (2, None, None), (3, 5.0, "b"), (4, 6.0, "b")]]
    df = spark.createDataFrame(data, "t string, x double, c string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {(r.column_name, r.window_start.day): r for r in drift.distribution_drift(df, "t", ["x"], ["c"]).collect()}
    assert got["x", 3].previous_window == at("2024-05-01")
    assert got["x", 3].ks_distance == 0 and got["x", 4].ks_distance == 1
    assert got["c", 3].js_divergence == 1 and got["c", 4].js_divergence == 0
    assert drift.distribution_drift(df.limit(0), "t", ["x"], ["c"]).count() == 0
    with pytest.raises(ValueError, match="name a column"):
        drift.distribution_drift(df, "t")


def test_kept_and_rejected_rows_add_up(spark):
    people = adapter.profiles(spark, SF)
    rules = profile_rules(adapter.AS_OF)
    report = {r.rule: r for r in quality.dq_report(people, rules).collect()}
    label = f"split{uuid.uuid4().hex}"
    with quality.split_by_rules(people, rules, label) as (good, bad, counts):
        assert counts == {"rows": people.count(), **{r: report[r].failed for r in rules}}
        assert rows(good) == rows(quality.expect_drop(people, rules))
        assert rows(good.unionByName(bad.drop("broken_rules"))) == rows(people)
        by_rule = {r.rule: r["count"] for r in bad.select(F.explode("broken_rules").alias("rule")).groupBy("rule").count().collect()}
        assert by_rule == {r: report[r].failed for r in rules if report[r].failed}
        assert bad.where("size(broken_rules) = 0").isEmpty()
        assert any(f.startswith(label) for f in folders(spark, f"{shared_dir(spark)}/linepulse"))
    assert not any(f.startswith(label) for f in folders(spark, f"{shared_dir(spark)}/linepulse"))


def test_a_null_predicate_is_broken(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, -1)], "id int, x int")
    rules = {"positive": F.col("x") > 0, "small": F.col("id") < 3}
    marked, _ = quality.judged(df, rules, f"null-{uuid.uuid4().hex}")
    assert rows(quality.rejected_rows(marked, rules)) == [(["positive", "small"], 3, -1), (["positive"], 1, None)]
    assert [r.id for r in quality.kept_rows(marked).collect()] == [2]
