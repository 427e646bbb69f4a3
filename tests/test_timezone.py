"""Timestamps are zone-less UTC wall time: results do not depend on the session zone."""

import pytest

from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["clean_assemblies", "epoch_zero_as_1970", "changelog_full", "mapped_projection"])
def test_same_result_in_another_session_zone(spark, name):
    con = duck(SF)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        res = compare(spark, con, name, SF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["hash_match"] and res["spark_rows"] == res["oracle_rows"], res
