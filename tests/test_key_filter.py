"""The Bloom filter ahead of an anti join: equal rows whatever its size, and what it keeps from the shuffle."""

import pytest
from pyspark.sql import functions as F

from catalink.operators.key_filter import WORDS, anti_join_filtered, key_filter, may_hold
from catalink.operators.links import new_links_only

KEYS = ["assm_id", "pkg_vrs_id"]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("words", [1, 64, WORDS])
def test_equals_plain_anti_join(spark, words):
    delta = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (3, None, "c"), (None, None, "d"), (5, 6, "e"), (7, 8, "f")], "assm_id long, pkg_vrs_id long, note string")
    existing = spark.createDataFrame([(1, 2), (1, 2), (3, None), (None, None), (9, 9), (8, 7)], "assm_id long, pkg_vrs_id long")
    plain = delta.join(existing, KEYS, "left_anti")
    assert _rows(anti_join_filtered(delta, existing, KEYS, words)) == _rows(plain)
    assert anti_join_filtered(delta.limit(0), existing, KEYS, words).count() == 0
    assert anti_join_filtered(delta, existing.limit(0), KEYS, words).count() == delta.count()


def test_hot_and_string_keys(spark):
    existing = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("name"))
    delta = spark.createDataFrame([("hot",), ("1",), ("new",), ("",), (None,)], "name string")
    assert _rows(anti_join_filtered(delta, existing, ["name"])) == [("",), ("new",), (None,)]


def test_rules_out_what_the_delta_lacks(spark):
    delta = spark.range(0, 2_000).select(F.col("id").alias("assm_id"), (F.col("id") * 7).alias("pkg_vrs_id"))
    existing = spark.range(1_000, 300_000).select(F.col("id").alias("assm_id"), (F.col("id") * 7).alias("pkg_vrs_id"))
    near = may_hold(existing, KEYS, key_filter(delta, KEYS))
    assert 1_000 <= near.count() < 1_000 + 600  # the shared keys, and few by chance
    assert near.join(delta, KEYS, "left_semi").count() == 1_000
    words = key_filter(delta, KEYS, 64)
    assert words.count() <= 64


def test_new_links_filter_a_large_target(spark, tmp_path):
    existing, delta = str(tmp_path / "existing"), str(tmp_path / "delta")
    spark.range(300_000).select(F.col("id").alias("assm_id"), (F.col("id") % 1000).alias("pkg_vrs_id")).write.parquet(existing)
    spark.range(299_900, 300_100).select(F.col("id").alias("assm_id"), (F.col("id") % 1000).alias("pkg_vrs_id")).write.parquet(delta)
    small, large = spark.read.parquet(delta), spark.read.parquet(existing)
    got = new_links_only(small.unionByName(small), large)
    assert sorted(r.assm_id for r in got.collect()) == list(range(300_000, 300_100))
    assert "_mask" in got._jdf.queryExecution().optimizedPlan().toString()
    back = new_links_only(large, small)  # a large delta goes without the filter
    assert back.count() == 299_900
    assert "_mask" not in back._jdf.queryExecution().optimizedPlan().toString()
