"""Plan guards: no registered job may contain a cross product, a nested-loop
join, a Python UDF or an RDD scan."""

import pytest

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "ExistingRDD")


def _names():
    from catalink.registry import QUERIES

    return list(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_plan_has_no_forbidden_operator(spark, name):
    from __spark_entry__ import queries

    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, (name, found)


def test_reader_pushes_filters_and_prunes_columns(spark, tmp_path):
    """A filter on a source column reaches the parquet scan; unused columns are not read."""
    from pyspark.sql import functions as F

    from catalink.sources.catalog import read_table
    from catalink.sources.schemas import SOURCE_SCHEMAS

    loc = str(tmp_path / "pkg_versions")
    spark.range(100).select(
        F.col("id"), (F.col("id") * 10).alias("time"), F.lit("m").alias("maintainer"),
        F.col("id").alias("src_pkg_ref"), F.lit("1.0").alias("version"),
    ).write.parquet(loc)
    df = read_table(spark, loc, SOURCE_SCHEMAS["pkg_versions"]).where(F.col("time") == 0).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(time), EqualTo(time,0)]" in plan, plan
    assert "ReadSchema: struct<id:bigint,time:bigint>" in plan, plan
    assert [r.id for r in df.collect()] == [0]
