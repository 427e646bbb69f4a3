"""Every registered job against its DuckDB oracle (the driver's check), at sf0.001."""

import pytest

from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


def _names():
    from catalink.registry import QUERIES

    return list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_job_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF)
    if res.get("oracle") == "none":
        pytest.skip("no SQL form")
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["hash_match"], res


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["pkg_vrs_id", "vulnerability_id", "changelog_string_number", "fixed_tracker_string_number"]
    assert df.count() == 1434  # by the reference's scope: every changelog row of a version in a build
