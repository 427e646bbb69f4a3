"""End-to-end jobs over folders: sources written from the fixture views at sf0.001."""

import pytest

from catalink.plans import jobs
from catalink.sources.catalog import read_sources
from catalink.sources.fixtures import fixture_catalogue

SF = "/root/testdata/sf0.001"
RUN_TS = "2025-02-11 00:00:00"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    fx = fixture_catalogue(spark, SF)
    for name, df in fx.sources.items():
        df.write.parquet(str(root / "sources" / name))
    for name in ("cve", "cve_rep", "pkg_version", "package"):
        getattr(fx.tracker, name).write.parquet(str(root / "tracker" / name))
    return root


def test_full_then_incremental_then_fix_status(spark, folders):
    sources = read_sources(spark, str(folders / "sources"))
    targets = str(folders / "targets")
    full = jobs.run_full_load(spark, sources, targets, RUN_TS)
    assert full["project"] > 0 and full["changelog"] > 0
    assert full["reject:assemblies_without_project"] + full["assembly"] == sources.assemblies.count()

    again = jobs.run_incremental_load(spark, sources, targets, RUN_TS)
    assert {k: v for k, v in again.items() if not k.startswith("reject:")} == {k: 0 for k in full if not k.startswith("reject:")}

    first = jobs.run_cve_fix_status(spark, targets, str(folders / "tracker"))
    before = sorted(map(tuple, jobs.read_loaded(spark, targets, "fixed_cve_status").collect()))
    assert first["fixed_cve_status"] == len(before) > 0
    assert first["changes_in_scope"] > 0 and first["reject:log_unknown_cves"] > 0 and first["reject:tracker_unknown_cves"] > 0
    assert jobs.read_rejects(spark, targets, "tracker_unknown_cves").count() == first["reject:tracker_unknown_cves"]
    jobs.run_cve_fix_status(spark, targets, str(folders / "tracker"))
    after = sorted(map(tuple, jobs.read_loaded(spark, targets, "fixed_cve_status").collect()))
    assert before == after  # merging the same evidence twice changes nothing


def test_incremental_from_empty_equals_full(spark, folders):
    sources = read_sources(spark, str(folders / "sources"))
    a = jobs.run_full_load(spark, sources, str(folders / "full"), RUN_TS)
    b = jobs.run_incremental_load(spark, sources, str(folders / "incr"), RUN_TS)
    for table in ("project", "assembly", "package", "pkg_version", "assm_pkg_vrs", "changelog"):
        assert a[table] == b[table], table
    report = {r.check_name: r.value for r in jobs.run_integrity_report(spark, sources, str(folders / "full")).collect()}
    assert report["links_missing_assembly"] + 0 <= report["total_links"]


def test_command_line_integrity_report(spark, folders, capsys):
    import json

    from catalink.__main__ import main

    assert main(["integrity-report", "--sources", str(folders / "sources"), "--targets", str(folders / "full")]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["assemblies"] > 0 and "links_missing_version" in report
