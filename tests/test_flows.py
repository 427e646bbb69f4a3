import pytest
from pyspark.sql import functions as F

from catalink.plans.load import full_load, incremental_load
from catalink.sources.fixtures import fixture_catalogue

SF = "/root/testdata/sf0.001"
RUN_TS = "2025-02-11 00:00:00"
KEYS = {"project": "prj_id", "assembly": "assm_id", "package": "pkg_id", "pkg_version": "pkg_vrs_id",
        "urgency": "urg_id", "vulnerabilities": "id", "changelog": "id"}
XW_TABLE = {"project": "projects", "assembly": "assemblies", "package": "src_packages", "pkg_version": "pkg_versions",
            "urgency": "urgency", "vulnerabilities": "vulnerabilities", "changelog": "changes"}


def rows(df, cols=None):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture(scope="module")
def sources(spark):
    return fixture_catalogue(spark, SF).sources


@pytest.fixture(scope="module")
def full(sources):
    return full_load(sources, RUN_TS)


@pytest.fixture(scope="module")
def incr(sources):
    return incremental_load(sources, RUN_TS, None, None)


def test_keys_unique_dense_and_backed_by_crosswalk(full):
    xw = full.crosswalk
    assert xw.groupBy("table_name", "old_id").count().where("count > 1").count() == 0
    for table, key in KEYS.items():
        keys = [r[0] for r in full.targets[table].select(key).collect()]
        assert sorted(keys) == list(range(1, len(keys) + 1)), table
        targets = {r.new_id for r in xw.where(F.col("table_name") == XW_TABLE[table]).select("new_id").collect()}
        assert targets <= set(keys), table


def test_rejects_plus_accepted_equals_input(sources, full):
    accepted = full.targets["assembly"].count()
    rejected = full.rejects["assemblies_without_project"].count()
    assert accepted + rejected == sources.assemblies.count()
    assert full.targets["assm_pkg_vrs"].count() == full.targets["assm_pkg_vrs"].distinct().count()


def test_full_equals_incremental_from_empty_on_shared_tables(full, incr):
    for table in ("project", "assembly", "package", "pkg_version", "assm_pkg_vrs"):
        assert rows(full.targets[table]) == rows(incr.targets[table]), table
    cols = ["id", "log_desc", "pkg_vrs_id"]
    assert rows(full.targets["changelog"], cols) == rows(incr.targets["changelog"], cols)
    # the incremental load gives every urgency row its own key, the full load one per name
    assert incr.targets["urgency"].count() >= full.targets["urgency"].count()


def test_second_incremental_load_adds_nothing(sources, incr):
    again = incremental_load(sources, RUN_TS, incr.targets, incr.crosswalk)
    counts = {r.table_name: r.n_rows for r in again.counts().collect()}
    assert set(counts.values()) == {0}, counts


def test_rejects_are_the_rows_without_a_parent(sources, full):
    from catalink.operators.audit import rejected_by_parent

    for name, df, key, table, ref in (
        ("assemblies_without_project", sources.assemblies, "id", "projects", "prj_ref"),
        ("versions_without_package", sources.pkg_versions, "id", "src_packages", "src_pkg_ref"),
        ("changes_without_version", sources.changes, "id", "pkg_versions", "pkg_vsn_ref"),
    ):
        got = full.rejects[name]
        want = rejected_by_parent(df, full.crosswalk, table, ref)
        assert rows(got, [F.col("id" if "id" in got.columns else "old_id")]) == rows(want, [key]), name
        assert want.count() > 0


def test_times_out_of_range_are_reported(spark, sources):
    odd = sources.assemblies.withColumn("time", F.when(F.col("id") % 100 == 0, F.lit(10**18)).otherwise(F.col("time")))
    report = full_load(sources.replace(assemblies=odd), RUN_TS).rejects["times_out_of_range"]
    n = sources.assemblies.where("id % 100 = 0").count()
    assert n > 0 and rows(report.select("table_name", "time").distinct()) == [("assemblies", 10**18)] and report.count() == n


def test_key_ranges_hold_every_row_once(spark):
    from catalink.sources.catalog import key_ranges

    df = spark.range(-5, 25).selectExpr("if(id = 24, null, id) AS id")
    for lo, hi, n in ((0, 19, 4), (-5, 23, 7), (3, 4, 10), (0, 0, 3), (None, None, 4), (0, 19, 1), (-7, -1, 3)):
        parts = key_ranges("id", lo, hi, n)
        assert 1 <= len(parts) <= max(n, 1)
        hits = df.selectExpr("id", " + ".join(f"if({p}, 1, 0)" for p in parts) + " AS hits")
        assert rows(hits.select("hits").distinct()) == [(1,)], (lo, hi, n)
