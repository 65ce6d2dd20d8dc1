"""Published snapshots: all at once or not at all; stages that go on where a run stopped."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.sources import snapshots as SN


def _tables(spark, n):
    a = spark.range(n).select("id", (F.lit(2000) + F.col("id") % 3).cast("int").alias("Year"))
    return {"panel": a, "list": a.select(F.col("id").alias("k")).where("k < 0")}


def test_published_and_pruned(spark, tmpdir_path):
    assert SN.published(spark, tmpdir_path, "panel") is None and SN.history(spark, tmpdir_path).count() == 0
    rows = SN.publish(_tables(spark, 10), tmpdir_path, "20260101", {"panel": ["Year"]})
    assert {(r.snapshot, r.table, r.rows) for r in rows.collect()} == {("20260101", "panel", 10), ("20260101", "list", 0)}
    SN.publish(_tables(spark, 20), tmpdir_path, "20260401", {"panel": ["Year"]})
    latest = SN.published(spark, tmpdir_path, "panel")
    assert latest.count() == 20 and dict(latest.dtypes) == {"id": "bigint", "Year": "int"}
    assert SN.published(spark, tmpdir_path, "panel", "20260101").count() == 10
    assert SN.published(spark, tmpdir_path, "list").count() == 0
    assert SN.published(spark, tmpdir_path, "panel", "19990101") is None
    one = latest.where("Year = 2001 AND id > 3")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan and "PushedFilters: [IsNotNull(id), GreaterThan(id,3)" in plan
    assert len(one.inputFiles()) == len(latest.inputFiles()) and {r.Year for r in one.collect()} == {2001}
    # what the manifest says is what lies there
    for r in SN.history(spark, tmpdir_path).collect():
        assert spark.read.schema("id long").parquet(r.path).count() == r.rows


def test_a_failed_write_changes_nothing(spark, tmpdir_path):
    SN.publish(_tables(spark, 10), tmpdir_path, "1")
    broken = _tables(spark, 30) | {"list": spark.range(5).select(F.raise_error(F.lit("stopped")).alias("k"))}
    with pytest.raises(Exception, match="stopped"):
        SN.publish(broken, tmpdir_path, "2")
    assert len(os.listdir(f"{tmpdir_path}/parts")) == 2  # the attempt left files that no reader sees
    assert SN.published(spark, tmpdir_path, "panel").count() == 10
    assert {r.snapshot for r in SN.history(spark, tmpdir_path).collect()} == {"1"}


def test_the_last_attempt_of_a_snapshot_counts(spark, tmpdir_path):
    SN.publish(_tables(spark, 10), tmpdir_path, "1")
    SN.publish(_tables(spark, 11), tmpdir_path, "1")
    assert SN.published(spark, tmpdir_path, "panel", "1").count() == 11


def test_conform(spark):
    df = spark.createDataFrame([("7", 1.5, "x")], "b string, `a c` double, more string")
    out = SN.conform(df, "`a c` double, b long")
    assert out.dtypes == [("a c", "double"), ("b", "bigint")] and out.collect() == [(1.5, 7)]
    with pytest.raises(ValueError, match="nothing, other"):
        SN.conform(df, "b long, nothing int, other date")


def test_stages_resume(spark, tmpdir_path):
    built = []

    def build(name, fails=False):
        def run():
            built.append(name)
            if fails:
                raise RuntimeError("stopped")
            return spark.range(3).withColumn("name", F.lit(name))
        return run

    def recipe(fails):
        SN.stage(spark, tmpdir_path, "one", "run1", build("one"), "id long, name string")
        return SN.stage(spark, tmpdir_path, "two", "run1", build("two", fails), "id int, name string", ["name"])

    with pytest.raises(RuntimeError):
        recipe(True)
    out = recipe(False)
    assert built == ["one", "two", "two"] and sorted(tuple(r) for r in out.collect()) == [(0, "two"), (1, "two"), (2, "two")]
    recipe(False)
    assert len(built) == 3
    SN.stage(spark, tmpdir_path, "one", "run2", build("one"), "id long, name string")
    assert built == ["one", "two", "two", "one"]
