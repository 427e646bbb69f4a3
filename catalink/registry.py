"""Registered jobs: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every job reads the driver's test tables through the fixture views and runs
the library's own operators on the whole of them.  ``catalink.oracle`` holds
the matching DuckDB SQL.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import clean as C
from .operators import audit, changelog as cl, crosswalk as xw, evidence as ev, links as lk, projection as pj
from .operators.keys import crosswalk_rows, dense_keys, key_bounds, union_crosswalks
from .operators.natural_key import distinct_names_keyed, get_or_create_by_name, get_or_create_version
from .plans.cve_status import merge_fix_status
from .plans.integrity import integrity_report
from .plans.load import LoadResult, full_load, incremental_load
from .plans.mapped_load import mapped_load
from .sources.catalog import conform, read_crosswalk
from .sources.fixtures import FixtureCatalogue, fixture_catalogue
from .sources.schemas import TARGET_SCHEMAS
from .sources.sinks import StageArea, write_crosswalk

# Fixed load time for every registered job, so that results repeat.
RUN_TS = "2025-02-11 00:00:00"

_CACHE: dict[str, tuple[SparkSession, FixtureCatalogue]] = {}


def fixtures(spark: SparkSession, sf_dir: str) -> FixtureCatalogue:
    """Fixture DataFrames (lazy plans, no data) per folder, rebuilt for a new session."""
    cached = _CACHE.get(sf_dir)
    if cached is None or cached[0] is not spark:
        cached = _CACHE[sf_dir] = (spark, fixture_catalogue(spark, sf_dir))
    return cached[1]


def _changelog(fx: FixtureCatalogue) -> DataFrame:
    """The fixture changes as repository changelog rows ``(id, pkg_vrs_id, log_desc)``."""
    return fx.sources.changes.select("id", F.col("pkg_vsn_ref").alias("pkg_vrs_id"), F.col("special").alias("log_desc"))


def _scope(fx: FixtureCatalogue) -> DataFrame:
    return ev.versions_in_builds(fx.repo_versions, fx.links_versions)


# --- step 2: CVE evidence ------------------------------------------------------
def q_cve_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return ev.change_mentions(_changelog(fx))


def q_cve_unknown_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    mentions = ev.change_mentions(_changelog(fx))
    return ev.unknown_mentions(mentions, fx.sources.vulnerabilities, fx.links_versions).select("chg_id", "cve")


def q_tracker_unknown_cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    names = ev.cve_ids_by_name(fx.sources.vulnerabilities)
    return ev.tracker_unknown_cves(fx.tracker, ev.repo_version_key(_scope(fx)), names)


def q_changes_in_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return ev.count_in_scope(_changelog(fx), fx.links_versions)


def q_first_change_per_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    first = ev.first_change_per_version(_changelog(fx).select("id", "pkg_vrs_id"))
    return first.join(ev.used_versions(fx.links_versions), "pkg_vrs_id", "left_semi")


def q_repo_version_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return ev.repo_version_key(_scope(fx))


def q_tracker_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return ev.tracker_fixes(fx.tracker, ev.repo_version_key(_scope(fx)), ev.cve_ids_by_name(fx.sources.vulnerabilities))


def q_cve_fix_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return ev.cve_fix_status(fx.repo_versions, fx.links_versions, _changelog(fx), fx.sources.vulnerabilities, fx.tracker)


# --- step 3: staging and cleaning ---------------------------------------------
def q_projects_with_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixtures(spark, sf_dir).sources
    return pj.projects_with_vendor(src.projects, src.publishers)


def q_mapped_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pj.mapped_projection(fixtures(spark, sf_dir).sources.assemblies, "assembly")


def _mapped_projection(target: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = fixtures(spark, sf_dir).sources
        if target == "project":
            staged = pj.projects_with_vendor(src.projects, src.publishers)
            base = staged.withColumnsRenamed({"old_id": "id", "vendor": pj.joined_column("publishers", "name")})
        elif target == "changelog":
            idents = cl.known_idents_per_change(src.chg_vln_lnk, src.vulnerabilities).select(
                F.col("chg_ref").alias("id"), F.col("log_ident").alias(pj.joined_column("vulnerabilities", "name"))
            )
            times = src.pkg_versions.select(
                F.col("id").alias("pkg_vsn_ref"), F.col("time").alias(pj.joined_column("pkg_versions", "time"))
            )
            base = src.changes.join(times, "pkg_vsn_ref", "left").join(idents, "id", "left")
        else:
            base = getattr(src, pj.MAPPING_BASE[target])
        return pj.mapped_projection(base, target)

    return query


def q_clean_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixtures(spark, sf_dir).sources
    return pj.clean_projects(pj.projects_with_vendor(src.projects, src.publishers))


def q_clean_assemblies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pj.clean_assemblies(fixtures(spark, sf_dir).sources.assemblies, RUN_TS)


def q_clean_pkg_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pj.clean_pkg_versions(fixtures(spark, sf_dir).sources.pkg_versions, RUN_TS)


def q_epoch_zero_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    pv = fixtures(spark, sf_dir).sources.pkg_versions
    return pv.select(F.col("id").alias("old_id"), C.epoch_to_ts_zero_null("time").alias("pkg_date_created"))


def q_epoch_zero_as_1970(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = fixtures(spark, sf_dir).sources.assemblies
    return a.select(F.col("id").alias("old_id"), C.epoch_or_load_time("time", RUN_TS, zero_is_null=False).alias("assm_date_created"))


def q_time_missing_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pj.missing_time_sample(fixtures(spark, sf_dir).sources.assemblies, 5)


# --- step 4: crosswalk -----------------------------------------------------------
def _delta_projects(fx: FixtureCatalogue) -> DataFrame:
    src = fx.sources
    return xw.only_new(pj.clean_projects(pj.projects_with_vendor(src.projects, src.publishers)), fx.crosswalk, "projects")


def q_delta_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delta_projects(fixtures(spark, sf_dir))


def _new_assembly_keys(fx: FixtureCatalogue, only_delta: bool = True) -> DataFrame:
    a = fx.sources.assemblies.select(F.col("id").alias("old_id"), "prj_ref")
    if only_delta:
        a = xw.only_new(a, fx.crosswalk, "assemblies")
    mapped = xw.remap(a, fx.crosswalk, "projects", "prj_ref", "prj_id")
    return dense_keys(mapped.select("old_id"), "old_id", "new_id", xw.max_new_id(fx.crosswalk, "assemblies"))


def q_new_keys_assemblies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _new_assembly_keys(fixtures(spark, sf_dir))


def q_remap_assemblies(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    a = fx.sources.assemblies.select(F.col("id").alias("old_id"), "prj_ref")
    return xw.remap(a, fx.crosswalk, "projects", "prj_ref", "prj_id")


def q_crosswalk_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    projects = dense_keys(_delta_projects(fx).select("old_id"), "old_id", "new_id", xw.max_new_id(fx.crosswalk, "projects"))
    # Keys for every assembly with a mapped project, already-mapped ones included:
    # the merge must keep each existing pair.
    assemblies = _new_assembly_keys(fx, only_delta=False)
    new = union_crosswalks(crosswalk_rows(projects, "projects"), crosswalk_rows(assemblies, "assemblies"))
    return xw.merge_crosswalk(fx.crosswalk, new)


def q_crosswalk_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xw.crosswalk_sizes(fixtures(spark, sf_dir).crosswalk)


def q_crosswalk_from_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    loaded = existing_targets(fx)
    targets = {name: loaded[name] for name in ("project", "assembly", "package", "pkg_version")}
    targets["changelog"] = _changelog(fx)
    targets["urgency"] = fx.sources.urgency.select(F.col("id").alias("urg_id"), F.col("name").alias("urg_name"))
    return xw.crosswalk_from_targets(targets)


def q_crosswalk_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild a saved crosswalk, append to it, and read it back."""
    pairs = fixtures(spark, sf_dir).crosswalk
    area = StageArea(spark, "crosswalk")
    location = f"{area.root}/crosswalk"
    _release_at_exit(area)
    later = F.col("table_name").isin("changes", "urgency")
    write_crosswalk(pairs.where(~later), location, mode="overwrite")
    write_crosswalk(pairs.where(later), location, mode="append")
    return read_crosswalk(spark, location)


# --- step 5: natural keys ----------------------------------------------------------
def existing_packages(fx: FixtureCatalogue) -> DataFrame:
    """Stand-in package target: names of source packages the crosswalk says are loaded."""
    pairs = xw.for_table(fx.crosswalk, "src_packages")
    src = fx.sources.src_packages.where(F.col("name").isNotNull()).hint("merge")
    return pairs.join(src, pairs["old_id"] == src["id"]).select(F.col("new_id").alias("pkg_id"), F.col("name").alias("pkg_name"))


def existing_versions(fx: FixtureCatalogue) -> DataFrame:
    """Stand-in pkg_version target: loaded versions whose package is loaded too."""
    pv = pj.clean_pkg_versions(fx.sources.pkg_versions, RUN_TS)
    loaded = xw.remap(pv, fx.crosswalk, "pkg_versions", "old_id", "pkg_vrs_id")
    keyed = xw.remap(loaded, fx.crosswalk, "src_packages", "src_pkg_ref", "pkg_id")
    return keyed.select("pkg_vrs_id", "pkg_date_created", "author_name", "pkg_id", "version")


def _package_mapping(fx: FixtureCatalogue) -> DataFrame:
    named = fx.sources.src_packages.where(F.col("name").isNotNull()).select(F.col("id").alias("old_id"), F.col("name").alias("pkg_name"))
    delta = xw.only_new(named, fx.crosswalk, "src_packages")
    mapping, _ = get_or_create_by_name(delta, existing_packages(fx))
    return mapping


def q_package_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _package_mapping(fixtures(spark, sf_dir)).select("old_id", "pkg_name", "pkg_id")


def q_version_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    area = StageArea(spark, "versions")
    _release_at_exit(area)
    # Staged as in the load flow: numbering reads its input more than once.
    packages, _ = area.put(_package_mapping(fx), "packages")
    pkg_pairs = union_crosswalks(fx.crosswalk, crosswalk_rows(packages, "src_packages", new_col="pkg_id"))
    pv = pj.clean_pkg_versions(fx.sources.pkg_versions, RUN_TS)
    delta = xw.only_new(pv, fx.crosswalk, "pkg_versions")
    mapped = xw.remap(delta, pkg_pairs, "src_packages", "src_pkg_ref", "pkg_id").drop("src_pkg_ref")
    mapped, seen = area.put(mapped, "delta", key_bounds("old_id"))
    existing, _ = area.put(existing_versions(fx), "existing")
    mapping, _ = get_or_create_version(
        mapped, existing, materialize=lambda df: area.put(df, "numbered")[0], bounds=(seen["lo"], seen["hi"])
    )
    return mapping.select("old_id", "pkg_id", "version", "pkg_vrs_id")


def q_distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = fixtures(spark, sf_dir).sources.vulnerabilities.select(F.col("id").alias("old_id"), "name")
    return distinct_names_keyed(v, "name", "id")


# --- step 6: links -------------------------------------------------------------------
def q_link_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return lk.remap_links(fx.sources.asm_pkg_vsn_lnk, fx.crosswalk).select("assm_id", "pkg_vrs_id")


def q_link_remap_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    remapped = lk.remap_links(fx.sources.asm_pkg_vsn_lnk, fx.crosswalk)
    # Stand-in for links loaded earlier: the pairs of every third build.
    existing = remapped.where(F.col("assm_id") % 3 == 0).select("assm_id", "pkg_vrs_id")
    return lk.new_links_only(remapped, existing)


# --- step 7: changelog ----------------------------------------------------------------
def q_changelog_idents(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixtures(spark, sf_dir).sources
    idents = cl.idents_per_change(src.chg_vln_lnk, src.vulnerabilities)
    return cl.attach_idents(src.changes.select(F.col("id").alias("chg_id")), idents, key="chg_id")


def q_changelog_idents_known_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixtures(spark, sf_dir).sources
    idents = cl.known_idents_per_change(src.chg_vln_lnk, src.vulnerabilities)
    out = cl.attach_idents(src.changes.select(F.col("id").alias("chg_id")), idents, key="chg_id")
    return out.withColumn("n_known", F.coalesce("n_known", F.lit(0)))


def _changelog_keyed(fx_: FixtureCatalogue, full: bool) -> DataFrame:
    src = fx_.sources
    ids = src.changes.select("id", "pkg_vsn_ref")
    changes = ids if full else xw.only_new(ids, fx_.crosswalk, "changes", key_col="id")
    narrow = cl.changelog_versions(changes, fx_.crosswalk, src.pkg_versions, RUN_TS, zero_is_null=not full)
    keyed = dense_keys(narrow, "old_id", "id", 0 if full else xw.max_new_id(fx_.crosswalk, "changes"))
    idents = cl.idents_per_change(src.chg_vln_lnk, src.vulnerabilities) if full else None
    return cl.with_text(keyed, src.changes, idents)


def q_changelog_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changelog_keyed(fixtures(spark, sf_dir), full=True)


def q_changelog_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changelog_keyed(fixtures(spark, sf_dir), full=False)


# --- step 8: audits ----------------------------------------------------------------------
def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.row_counts(fixtures(spark, sf_dir).sources.items())


def q_orphan_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixtures(spark, sf_dir).sources
    staged = pj.projects_with_vendor(src.projects, src.publishers)
    return audit.orphan_refs(src.assemblies, "prj_ref", staged, "old_id", "assemblies.prj_ref").unionByName(
        audit.orphan_refs(src.pkg_versions, "src_pkg_ref", src.src_packages, "id", "pkg_versions.src_pkg_ref")
    )


def q_link_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return audit.link_audit(fx.sources.asm_pkg_vsn_lnk, fx.crosswalk)


def q_link_audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return audit.link_audit_sample(fx.sources.asm_pkg_vsn_lnk, fx.crosswalk, 10)


def q_assembly_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = fixtures(spark, sf_dir).sources.assemblies
    return audit.table_sample(a, [F.col("id").alias("old_id"), "prj_ref", "time"], ["old_id"], 10)


def q_rejected_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    delta = xw.only_new(fx.sources.pkg_versions, fx.crosswalk, "pkg_versions", key_col="id")
    return audit.rejected_by_parent(delta, fx.crosswalk, "src_packages", "src_pkg_ref").select(
        F.col("id").alias("old_id"), "src_pkg_ref"
    )


def q_rejected_change_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    src = fx.sources
    # The run's own maps: a change is loaded when its version is mapped; a CVE when it has a name.
    changes = xw.remap(src.changes, fx.crosswalk, "pkg_versions", "pkg_vsn_ref", "_v").select(F.col("id").alias("old_id"))
    cves = src.vulnerabilities.where(F.col("name").isNotNull()).select(F.col("id").alias("old_id"))
    run_map = union_crosswalks(
        crosswalk_rows(changes.withColumn("new_id", F.col("old_id")), "changes"),
        crosswalk_rows(cves.withColumn("new_id", F.col("old_id")), "vulnerabilities"),
    )
    return audit.rejected_change_links(src.chg_vln_lnk, run_map)


# --- step 9: merge into the fix-status table ------------------------------------------
def q_cve_fix_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both sides of the merge come from one computation of the status.
    area = StageArea(spark, "fix-status")
    _release_at_exit(area)
    status, _ = area.put(q_cve_fix_status(spark, sf_dir), "status")
    # Stand-in for the table as saved by an earlier run: every third version's rows,
    # one number missing on even CVE ids, tracker gaps filled with -1, a user id set.
    existing = status.where(F.col("pkg_vrs_id") % 3 == 0).select(
        "pkg_vrs_id",
        "vulnerability_id",
        F.when(F.col("vulnerability_id") % 2 == 0, None).otherwise(F.col("changelog_string_number")).alias("changelog_string_number"),
        F.coalesce("fixed_tracker_string_number", F.lit(-1)).cast("long").alias("fixed_tracker_string_number"),
        F.lit(1).cast("long").alias("manual_input_user_id"),
    )
    incoming = status.withColumn("manual_input_user_id", F.lit(None).cast("long"))
    return merge_fix_status(existing, incoming)


# --- step 10: whole flows ----------------------------------------------------------------
def _release_at_exit(result):
    """The returned frames read the run's staged files, so they are dropped when the process ends."""

    def release() -> None:
        try:
            result.release()
        except Exception:  # noqa: BLE001 - the JVM may already be gone
            pass

    atexit.register(release)
    return result


_FLOWS: dict[tuple[str, str], tuple[SparkSession, LoadResult]] = {}


def _flow(spark: SparkSession, sf_dir: str, name: str) -> LoadResult:
    """The result of a load flow, run once per folder and session; its tables are staged files."""
    held = _FLOWS.get((name, sf_dir))
    if held is None or held[0] is not spark:
        fx = fixtures(spark, sf_dir)
        if name == "full":
            result = full_load(fx.sources, RUN_TS)
        elif name == "incremental":
            result = incremental_load(fx.sources, RUN_TS, existing_targets(fx), fx.crosswalk)
        else:
            result = mapped_load(fx.sources)
        held = _FLOWS[name, sf_dir] = (spark, _release_at_exit(result))
    return held[1]


def _flow_table(name: str, table: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = _flow(spark, sf_dir, name)
        return result.crosswalk if table == "crosswalk" else result.targets[table]

    return query


def q_full_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flow(spark, sf_dir, "full").counts()


def existing_targets(fx: FixtureCatalogue) -> dict[str, DataFrame]:
    """Stand-in targets matching the fixture crosswalk (rows an earlier run loaded)."""
    loaded_links = lk.remap_links(fx.sources.asm_pkg_vsn_lnk, fx.crosswalk).select("assm_id", "pkg_vrs_id").distinct()
    return {
        "project": conform(xw.for_table(fx.crosswalk, "projects").select(F.col("new_id").alias("prj_id")), TARGET_SCHEMAS["project"]),
        "assembly": conform(xw.for_table(fx.crosswalk, "assemblies").select(F.col("new_id").alias("assm_id")), TARGET_SCHEMAS["assembly"]),
        "package": existing_packages(fx),
        "pkg_version": existing_versions(fx),
        "assm_pkg_vrs": loaded_links,
    }


def q_incremental_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flow(spark, sf_dir, "incremental").counts()


def q_mapped_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _flow(spark, sf_dir, "mapped")
    # Rows whose time is out of range are loaded all the same: reported, not rejected.
    rejected = [(f"reject:{name}", df) for name, df in result.rejects.items() if name != "times_out_of_range"]
    return result.counts().unionByName(audit.row_counts(rejected))


def q_integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fixtures(spark, sf_dir)
    return integrity_report(fx.sources, fx.crosswalk)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cve_mentions": q_cve_mentions,
    "cve_unknown_mentions": q_cve_unknown_mentions,
    "first_change_per_version": q_first_change_per_version,
    "repo_version_key": q_repo_version_key,
    "tracker_fixes": q_tracker_fixes,
    "tracker_unknown_cves": q_tracker_unknown_cves,
    "changes_in_scope": q_changes_in_scope,
    "cve_fix_status": q_cve_fix_status,
    "projects_with_vendor": q_projects_with_vendor,
    "mapped_projection": q_mapped_projection,
    "clean_projects": q_clean_projects,
    "clean_assemblies": q_clean_assemblies,
    "clean_pkg_versions": q_clean_pkg_versions,
    "epoch_zero_as_null": q_epoch_zero_as_null,
    "epoch_zero_as_1970": q_epoch_zero_as_1970,
    "time_missing_sample": q_time_missing_sample,
    "delta_projects": q_delta_projects,
    "new_keys_assemblies": q_new_keys_assemblies,
    "remap_assemblies": q_remap_assemblies,
    "crosswalk_merge": q_crosswalk_merge,
    "crosswalk_sizes": q_crosswalk_sizes,
    "crosswalk_from_targets": q_crosswalk_from_targets,
    "crosswalk_round_trip": q_crosswalk_round_trip,
    "package_get_or_create": q_package_get_or_create,
    "version_get_or_create": q_version_get_or_create,
    "distinct_names": q_distinct_names,
    "link_remap": q_link_remap,
    "link_remap_new_only": q_link_remap_new_only,
    "changelog_idents": q_changelog_idents,
    "changelog_idents_known_only": q_changelog_idents_known_only,
    "changelog_full": q_changelog_full,
    "changelog_delta": q_changelog_delta,
    "row_counts": q_row_counts,
    "orphan_refs": q_orphan_refs,
    "link_audit": q_link_audit,
    "link_audit_sample": q_link_audit_sample,
    "assembly_sample": q_assembly_sample,
    "rejected_versions": q_rejected_versions,
    "rejected_change_links": q_rejected_change_links,
    "cve_fix_upsert": q_cve_fix_upsert,
    "full_load_counts": q_full_load_counts,
    "incremental_load_counts": q_incremental_load_counts,
    "mapped_load_counts": q_mapped_load_counts,
    "integrity_report": q_integrity_report,
}

LOADED = ("project", "assembly", "package", "pkg_version", "urgency", "vulnerabilities", "assm_pkg_vrs", "changelog", "crosswalk")
for _load in ("full", "incremental", "mapped"):
    for _table in LOADED:
        if _load != "mapped" or _table != "vulnerabilities":  # the declared mapping has no CVE target
            QUERIES[f"{_load}_load_{_table}"] = _flow_table(_load, _table)
for _target in ("project", "package", "pkg_version", "assm_pkg_vrs", "changelog", "urgency"):
    QUERIES[f"mapped_projection_{_target}"] = _mapped_projection(_target)
