"""Which package versions fix which CVEs: log evidence + tracker evidence (W4 core).

Inputs, all DataFrames in repository terms:

* ``versions``  - ``(pkg_vrs_id, pkg_name, version)``: the repository's
  package versions with their package name (see ``repo_versions``);
* ``links``     - ``(pkg_vrs_id, ...)``: versions that occur in a build
  (``assm_pkg_vrs``); they alone set the scope of the log evidence, whether
  a version has a package row or not;
* ``changelog`` - ``(id, pkg_vrs_id, log_desc)``;
* ``vulnerabilities`` - ``(id, name)``;
* the tracker catalogue ``cve, cve_rep, pkg_version, package``.

Output ``(pkg_vrs_id, vulnerability_id, changelog_string_number,
fixed_tracker_string_number)``, unique on ``(pkg_vrs_id, vulnerability_id)``.

Plan shape: each evidence side is aggregated to one row per
``(version, CVE)`` before the full outer join, so the join never fans out and
is hash-partitioned on both key columns (no single hot key can own a
partition).  Nothing is broadcast by hint: adaptive execution chooses from
the sizes it meets at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import present
from ..functions.cve import explode_cves
from ..sources.catalog import TrackerCatalogue


def repo_versions(pkg_version: DataFrame, package: DataFrame) -> DataFrame:
    """``(pkg_vrs_id, pkg_name, version)`` from the target tables pkg_version and package."""
    return pkg_version.select("pkg_vrs_id", "pkg_id", "version").join(
        package.select("pkg_id", "pkg_name"), "pkg_id"
    ).drop("pkg_id")


def used_versions(links: DataFrame) -> DataFrame:
    """distinct ids of the versions that occur in at least one build.

    The link table is the big one (builds x versions); a partial aggregate
    de-duplicates map-side, so a version present in a third of all builds
    costs one row per task, not a third of the shuffle.
    """
    return links.where(F.col("pkg_vrs_id").isNotNull()).select("pkg_vrs_id").distinct()


def versions_in_builds(versions: DataFrame, links: DataFrame) -> DataFrame:
    """Package versions (with their package's name) that occur in at least one build.

    Only the tracker's name map needs these; log evidence takes every
    version of ``used_versions``.
    """
    return versions.join(used_versions(links), "pkg_vrs_id", "left_semi")


def count_in_scope(changelog: DataFrame, links: DataFrame) -> DataFrame:
    """One row ``n_changes``: changelog rows of versions that occur in a build."""
    per_version = changelog.groupBy("pkg_vrs_id").agg(F.count(F.lit(1)).alias("n"))
    scoped = per_version.join(used_versions(links), "pkg_vrs_id", "left_semi")
    return scoped.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_changes"))


def first_change_per_version(changes: DataFrame) -> DataFrame:
    """Lowest changelog id per version (partial aggregate before the shuffle)."""
    return changes.groupBy("pkg_vrs_id").agg(F.min("id").alias("first_chg_id"))


def cve_ids_by_name(vulnerabilities: DataFrame) -> DataFrame:
    """One id per CVE name; with repeated names the largest id wins.

    NULL names never match anything (R18), so they are dropped here.
    """
    return (
        vulnerabilities.where(F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.max("id").alias("vulnerability_id"))
    )


def change_mentions(changes: DataFrame) -> DataFrame:
    """X10 + X13 + F9: distinct ``(chg_id, pkg_vrs_id, cve)`` per changelog row."""
    return explode_cves(
        changes.select(F.col("id").alias("chg_id"), "pkg_vrs_id", "log_desc"),
        "log_desc",
        "cve",
        keep=["chg_id", "pkg_vrs_id"],
    )


def unknown_mentions(mentions: DataFrame, vulnerabilities: DataFrame, links: DataFrame) -> DataFrame:
    """F8, log side: in-scope mentions of CVE names the vulnerability table does not know."""
    names = cve_ids_by_name(vulnerabilities).select(F.col("name").alias("cve"))
    return mentions.join(names, "cve", "left_anti").join(used_versions(links), "pkg_vrs_id", "left_semi")


def log_evidence(mentions: DataFrame, cve_ids: DataFrame) -> DataFrame:
    """J13 + A7: first changelog id per (version, known CVE).

    ``min`` fixes the choice the reference left to read order (R13).  The
    min is computed map-side first, so a hot version or CVE shrinks to one
    row per task before the shuffle.
    """
    names = cve_ids.withColumnRenamed("name", "cve")
    return (
        mentions.join(names, "cve")
        .groupBy("pkg_vrs_id", "vulnerability_id")
        .agg(F.min("chg_id").alias("changelog_string_number"))
    )


def repo_version_key(scope: DataFrame) -> DataFrame:
    """J11 build side: ``(pkg_name, version) -> pkg_vrs_id``.

    The name must be present and not empty (F6); a NULL version is a key
    like any other (Python tuple keys), so the match uses null-safe
    equality.  One id per key: the largest, a fixed choice for what a dict
    build left to iteration order.
    """
    return (
        scope.where(present("pkg_name"))
        .groupBy("pkg_name", "version")
        .agg(F.max("pkg_vrs_id").alias("pkg_vrs_id"))
    )


def tracker_rows(tracker: TrackerCatalogue, cves: DataFrame, label: str) -> DataFrame:
    """``(label, version, pkg_name)`` of every tracker fix of ``cves(cve_id, label)``."""
    rep = tracker.cve_rep.select("cve_id", "fixed_pkg_vrs_id")
    return (
        cves.select("cve_id", label)
        .join(rep, "cve_id")
        .join(
            tracker.pkg_version.select(F.col("pkg_vrs_id").alias("fixed_pkg_vrs_id"), "pkg_id", "version"),
            "fixed_pkg_vrs_id",
        )
        .join(tracker.package.select("pkg_id", "pkg_name"), "pkg_id")
        .select(label, "version", "pkg_name")
    )


def _matched_to_versions(rows: DataFrame, version_key: DataFrame) -> DataFrame:
    """Adds the ``pkg_vrs_id`` of the same package name and (null-safe) version."""
    key = version_key.select(F.col("pkg_name").alias("_kn"), F.col("version").alias("_kv"), "pkg_vrs_id")
    return rows.join(key, (rows["pkg_name"] == key["_kn"]) & rows["version"].eqNullSafe(key["_kv"])).drop("_kn", "_kv")


def tracker_fixes(tracker: TrackerCatalogue, version_key: DataFrame, cve_ids: DataFrame) -> DataFrame:
    """J11 + J13: distinct ``(pkg_vrs_id, vulnerability_id)`` the tracker says are fixed.

    The tracker's CVEs are reduced to known ids first, so that long ids, not
    name strings, go through the joins and the two distincts.
    """
    known = tracker.cve.join(cve_ids.withColumnRenamed("name", "cve_name"), "cve_name").select("cve_id", "vulnerability_id")
    rows = tracker_rows(tracker, known, "vulnerability_id").distinct()
    return _matched_to_versions(rows, version_key).select("pkg_vrs_id", "vulnerability_id").distinct()


def tracker_unknown_cves(tracker: TrackerCatalogue, version_key: DataFrame, cve_ids: DataFrame) -> DataFrame:
    """F8, tracker side: ``(cve_name, pkg_vrs_id)`` that match a built version, but whose CVE is unknown."""
    names = cve_ids.select(F.col("name").alias("cve_name"))
    unknown = tracker.cve.join(names, "cve_name", "left_anti").select("cve_id", "cve_name")
    rows = tracker_rows(tracker, unknown, "cve_name").distinct()
    return _matched_to_versions(rows, version_key).select("cve_name", "pkg_vrs_id").distinct()


def tracker_evidence(fixes: DataFrame, first_change: DataFrame) -> DataFrame:
    """The tracker's number is the version's first changelog id (NULL if none)."""
    return fixes.join(first_change, "pkg_vrs_id", "left").select(
        "pkg_vrs_id", "vulnerability_id", F.col("first_chg_id").alias("fixed_tracker_string_number")
    )


def merge_evidence(log_ev: DataFrame, trk_ev: DataFrame) -> DataFrame:
    """Full outer join of both sides on (version, CVE)."""
    return log_ev.join(trk_ev, ["pkg_vrs_id", "vulnerability_id"], "full").select(
        "pkg_vrs_id", "vulnerability_id", "changelog_string_number", "fixed_tracker_string_number"
    )


def cve_fix_status(
    versions: DataFrame,
    links: DataFrame,
    changelog: DataFrame,
    vulnerabilities: DataFrame,
    tracker: TrackerCatalogue,
) -> DataFrame:
    """The fix-status rows to merge into ``fixed_cve_status``.

    The changelog (the big table, with free text) is aggregated before it is
    restricted to the versions in builds: both aggregates group by version,
    so dropping out-of-scope groups afterwards equals dropping rows before,
    and the text never crosses a shuffle - CVE tokens are extracted in the
    scan stage and only ``(version, CVE, min id)`` partial aggregates move.
    Log evidence needs no package row; the tracker's name map does.
    """
    cve_ids = cve_ids_by_name(vulnerabilities)
    log_ev = log_evidence(change_mentions(changelog), cve_ids).join(used_versions(links), "pkg_vrs_id", "left_semi")
    fixes = tracker_fixes(tracker, repo_version_key(versions_in_builds(versions, links)), cve_ids)
    # ``fixes`` holds in-scope versions only, so the left join needs no scope filter of its own.
    trk_ev = tracker_evidence(fixes, first_change_per_version(changelog.select("id", "pkg_vrs_id")))
    return merge_evidence(log_ev, trk_ev)
