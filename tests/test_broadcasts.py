"""Lookups that grow with the catalogue do not pass through the driver, though their files are small."""

import re

import pytest
from pyspark.sql import functions as F

from catalink.operators.changelog import changelog_versions
from catalink.operators.crosswalk import merge_crosswalk, only_new, remap
from catalink.operators.keys import crosswalk_rows
from catalink.operators.links import mapped_links, new_links_only
from catalink.operators.natural_key import get_or_create_by_name, get_or_create_version


def broadcast_joins(df):
    """Joins of the plan that ran which broadcast a side; the offsets of ``dense_keys`` are bounded by their bit width."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString()
    assert "Join" in plan
    return [j for j in re.findall(r"Broadcast\w*Join \[\w+", plan) if "[_b" not in j]


@pytest.fixture
def saved(tmp_path):
    def save(df, name):
        df.write.parquet(str(tmp_path / name))
        return df.sparkSession.read.parquet(str(tmp_path / name))

    return save


@pytest.fixture
def pairs(spark, saved):
    numbers = spark.range(0, 2000).select(F.col("id").alias("old_id"), (F.col("id") + 10**6).alias("new_id"))
    tables = [crosswalk_rows(numbers, t) for t in ("pkg_versions", "assemblies", "projects")]
    return saved(tables[0].unionByName(tables[1]).unionByName(tables[2]), "pairs")


def test_crosswalk_lookups(spark, pairs):
    rows = spark.range(1000, 3000).select(F.col("id").alias("old_id"), (F.col("id") % 500).alias("prj_ref"))
    for out, n in (
        (remap(rows, pairs, "projects", "prj_ref", "prj_id"), 2000),
        (remap(rows, pairs, "projects", "old_id", "prj_id", "left"), 2000),
        (only_new(rows, pairs, "projects"), 1000),
        (merge_crosswalk(pairs, crosswalk_rows(rows.withColumn("new_id", F.lit(1)), "projects")), 7000),
    ):
        assert out.count() == n
        assert broadcast_joins(out) == []


def test_changelog_versions(spark, pairs, saved):
    versions = saved(spark.range(2000).select("id", F.lit(5).cast("long").alias("time")), "versions")
    changes = spark.range(3000).select("id", (F.col("id") + 500).alias("pkg_vsn_ref"))
    out = changelog_versions(changes, pairs, versions, "2025-02-11 00:00:00", how="left")
    assert out.where("pkg_vrs_id IS NOT NULL").count() == 1500 and out.count() == 3000
    assert broadcast_joins(out) == []


def test_natural_keys(spark, saved):
    ran = []

    def written(df):
        ran.extend(broadcast_joins(df))
        return saved(df, f"numbered-{len(df.columns)}")

    names = saved(spark.range(3000).select(F.col("id").alias("old_id"), (F.col("id") % 900).cast("string").alias("pkg_name")), "names")
    known = saved(spark.range(100).select(F.col("id").alias("pkg_id"), F.col("id").cast("string").alias("pkg_name")), "known")
    mapping, created = get_or_create_by_name(names, known, materialize=written, bounds=(0, 2999))
    assert mapping.count() == 3000 and created.count() == 800
    assert broadcast_joins(mapping) == [] and ran == []
    versions = names.select("old_id", F.col("old_id").alias("pkg_id"), F.col("pkg_name").alias("version"), F.lit("x").alias("author_name"))
    loaded = saved(spark.range(100).select(F.col("id").alias("pkg_id"), F.col("id").cast("string").alias("version"), F.col("id").alias("pkg_vrs_id")), "loaded")
    mapping, created = get_or_create_version(versions, loaded, materialize=written, bounds=(0, 2999))
    assert mapping.count() == 3000 and created.count() == 2900
    assert broadcast_joins(mapping) == [] and ran == []


def test_links(spark, pairs, saved):
    links = saved(spark.range(3000).select(F.col("id").alias("asm_ref"), (F.col("id") % 7).alias("pkg_vsn_ref")), "links")
    mapped = mapped_links(links, pairs)
    assert mapped.count() == 3000
    assert broadcast_joins(mapped) == []
    delta = saved(mapped.where("assm_id IS NOT NULL").select("assm_id", "pkg_vrs_id"), "delta")
    target = saved(delta.where("assm_id % 2 = 0"), "target")
    new = new_links_only(delta.unionByName(delta), target)
    assert new.count() == 1000
    assert broadcast_joins(new) == []
