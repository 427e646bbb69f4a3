from catalink.operators import evidence as ev
from catalink.sources.catalog import TrackerCatalogue


def test_fix_status_edges(spark):
    versions = spark.createDataFrame(
        [(1, "pkg", "1.0"), (2, "pkg", None), (3, "", "1.0"), (4, "other", "2.0")],
        "pkg_vrs_id long, pkg_name string, version string",
    )
    links = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,)], "pkg_vrs_id long")
    changelog = spark.createDataFrame(
        [(10, 1, "fixes CVE-2020-0001 and CVE-2020-0001"), (11, 1, "CVE-2020-0002"), (12, 4, None), (13, 4, "CVE-2020-0001")],
        "id long, pkg_vrs_id long, log_desc string",
    )
    # duplicate name: the largest id wins; NULL name never matches
    vulns = spark.createDataFrame([(100, "CVE-2020-0001"), (101, "CVE-2020-0001"), (102, "CVE-2020-0002"), (103, None)], "id long, name string")
    tracker = TrackerCatalogue(
        cve=spark.createDataFrame([(1, "CVE-2020-0002"), (2, None), (3, "CVE-2020-0001")], "cve_id long, cve_name string"),
        cve_rep=spark.createDataFrame([(1, 501), (2, 502), (3, 502), (3, 503)], "cve_id long, fixed_pkg_vrs_id long"),
        pkg_version=spark.createDataFrame([(501, 9, None), (502, 9, "1.0"), (503, 8, "1.0")], "pkg_vrs_id long, pkg_id long, version string"),
        package=spark.createDataFrame([(9, "pkg"), (8, "")], "pkg_id long, pkg_name string"),
    )
    out = sorted(map(tuple, ev.cve_fix_status(versions, links, changelog, vulns, tracker).collect()))
    assert out == [
        (1, 101, 10, 10),  # log and tracker (NULL-safe version match is not needed here)
        (1, 102, 11, None),  # log only
        (2, 102, None, None),  # tracker only, NULL version equals NULL version; version 2 has no changelog
        (4, 101, 13, None),  # NULL text skipped, not an error
    ]
