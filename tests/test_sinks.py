import os

import pytest
from pyspark.sql import functions as F

from catalink.sources.catalog import read_crosswalk
from catalink.sources.sinks import write_replace, write_swap


def test_write_swap_replaces_a_table_it_reads(spark, tmp_path):
    loc = str(tmp_path / "t")
    write_replace(spark.range(5).withColumn("v", F.lit(1)), loc)
    current = spark.read.parquet(loc)
    write_swap(current.withColumn("v", F.col("v") + 1).unionByName(spark.range(5, 7).withColumn("v", F.lit(0))), loc)
    got = sorted(map(tuple, spark.read.parquet(loc).collect()))
    assert got == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 2), (5, 0), (6, 0)]
    assert [p for p in os.listdir(tmp_path) if "__" in p] == []


def test_missing_crosswalk_is_empty(spark, tmp_path):
    assert read_crosswalk(spark, str(tmp_path / "nope")).count() == 0


def test_crosswalk_rebuild_replaces_every_table(spark, tmp_path):
    from catalink.sources.sinks import write_crosswalk

    loc = str(tmp_path / "xw")
    old = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "table_name string, old_id long, new_id long")
    write_crosswalk(old, loc, mode="overwrite")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_crosswalk(spark.createDataFrame([("a", 1, 11)], "table_name string, old_id long, new_id long"), loc, mode="overwrite")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    got = sorted(map(tuple, read_crosswalk(spark, loc).collect()))
    assert got == [("a", 1, 11)]


def test_scale_settings_bound_partitions():
    from catalink.session import scale_settings

    small = scale_settings(10 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    big = scale_settings(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)


def table_of(spark, loc):
    return sorted(map(tuple, spark.read.parquet(loc).collect()))


def test_one_large_table_of_the_crosswalk_is_written_by_many_tasks(spark, tmp_path):
    from catalink.sources.sinks import write_crosswalk

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        pairs = spark.range(0, 400000, 1, 16).selectExpr("if(id < 10, 'urgency', 'changes') table_name", "id old_id", "id * 7 new_id")
        write_crosswalk(pairs, str(tmp_path / "xw"), mode="overwrite")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [p for p in os.listdir(tmp_path / "xw" / "table_name=changes") if p.endswith(".parquet")]
    assert len(files) > 2
    assert read_crosswalk(spark, str(tmp_path / "xw")).count() == 400000


@pytest.mark.parametrize("cut", ["before", "between", "after"])
def test_a_swap_cut_short_loses_nothing(spark, tmp_path, cut):
    """The states a crash can leave: new content written, old moved aside, new moved in."""
    from catalink.sources.sinks import recover_swap

    loc = str(tmp_path / "t")
    write_replace(spark.range(3).select("id"), loc)
    write_replace(spark.range(5).select("id"), f"{loc}.__next_1")
    if cut != "before":
        os.rename(loc, f"{loc}.__old_1")
    if cut == "after":
        os.rename(f"{loc}.__next_1", loc)
    assert recover_swap(spark, loc)
    assert len(table_of(spark, loc)) == (3 if cut == "before" else 5)
    assert os.listdir(tmp_path) == ["t"]
    assert not recover_swap(spark, str(tmp_path / "missing"))


def test_a_swap_without_new_content_puts_the_old_back(spark, tmp_path):
    from catalink.sources.sinks import recover_swap

    loc = str(tmp_path / "t")
    write_replace(spark.range(3).select("id"), f"{loc}.__old_1")
    assert recover_swap(spark, loc) and len(table_of(spark, loc)) == 3


def test_fix_status_keeps_user_ids_after_a_crash(spark, tmp_path):
    from catalink.plans.cve_status import run_fix_status
    from catalink.sources.catalog import conform
    from catalink.sources.schemas import TARGET_SCHEMAS

    schema = TARGET_SCHEMAS["fixed_cve_status"]
    row = lambda *v: conform(spark.createDataFrame([v], schema), schema)
    loc = str(tmp_path / "fixed")
    write_replace(row(1, 2, 5, 6, 42), loc)
    os.rename(loc, f"{loc}.__old_x")  # as after the first of the two renames, the new content lost
    assert run_fix_status(spark, loc, row(1, 2, 7, 7, None)) == 1
    assert table_of(spark, loc) == [(1, 2, 5, 6, 42)]
    assert run_fix_status(spark, loc, row(1, 2, 7, 7, None).limit(0)) == 0
