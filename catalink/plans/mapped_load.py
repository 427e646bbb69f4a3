"""Load by declared column mapping (W3), with reject frames.

Each target is projected from its source by ``DECLARED_MAPPING`` (P1-P5),
the source key is dropped and a new one made (P4, K1), and foreign keys go
through the maps made earlier in the same run (J9).  Rows whose parent is
not mapped are returned as rejects instead of being skipped one by one, and
one bad row no longer rolls back the rows before it (R1, R12).

What the declared mapping fixes (and the other loads do not): times are
converted as stored (NULL stays NULL, 0 is 1970-01-01, X7), except a change's
date, where 0 also gives NULL (X8); text is not cleaned; ``log_ident`` lists
only CVE ids known to the CVE table (A5).  Packages are one per distinct
non-null name (a second row of a name gets the first one's key, where a
unique-name insert would fail).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import audit
from ..operators.changelog import known_idents_per_change
from ..operators.crosswalk import remap
from ..operators.keys import crosswalk_rows, dense_keys, key_bounds, union_crosswalks
from ..operators.natural_key import get_or_create_by_name
from ..operators.projection import joined_column, mapped_projection, projects_with_vendor, rejected_projects
from ..sources.catalog import SourceCatalogue, empty_target
from ..sources.sinks import StageArea
from ..sources.schemas import TARGET_SCHEMAS
from .load import LoadResult


def mapped_load(sources: SourceCatalogue, cut_lineage: bool = True) -> LoadResult:
    """Every target by the declared mapping; staged tables go if a step fails."""
    stage = StageArea(sources.projects.sparkSession, "mapped") if cut_lineage else None
    try:
        return _run_steps(sources, stage)
    except BaseException:
        if stage is not None:
            stage.release()
        raise


def _run_steps(sources: SourceCatalogue, stage: StageArea | None) -> LoadResult:
    spark = sources.projects.sparkSession

    def keep(df: DataFrame) -> DataFrame:
        return stage.put(df, "step")[0] if stage is not None else df

    def numbered(df: DataFrame, key_col: str) -> DataFrame:
        """New keys by ``old_id``; the input is staged first and its id range observed."""
        if stage is None:
            return dense_keys(df, "old_id", key_col)
        staged, stats = stage.put(df, "rows", key_bounds("old_id"))
        return keep(dense_keys(staged, "old_id", key_col, bounds=(stats["lo"], stats["hi"])))

    out: dict[str, DataFrame] = {}
    rejects: dict[str, DataFrame] = {}
    maps: list[DataFrame] = []

    # Where an id repeats, its rows are numbered in the order that these joins give them: left to Catalyst, as ever.
    def run_map() -> DataFrame:
        return union_crosswalks(*maps)

    rejects["times_out_of_range"] = audit.times_out_of_range(
        [("assemblies", sources.assemblies), ("pkg_versions", sources.pkg_versions)]
    )

    # project: projects joined with publishers (vendor), new key per row
    rejects["projects_without_publisher"] = rejected_projects(sources.projects, sources.publishers)
    staged = projects_with_vendor(sources.projects, sources.publishers).withColumnRenamed("vendor", joined_column("publishers", "name"))
    projected = mapped_projection(staged.withColumnRenamed("old_id", "id"), "project")
    keyed = numbered(projected.withColumnRenamed("prj_id", "old_id"), "prj_id")
    out["project"] = keyed.select(*TARGET_SCHEMAS["project"].fieldNames())
    maps.append(crosswalk_rows(keyed, "project", new_col="prj_id"))

    # assembly: project key through the run's project map
    projected = mapped_projection(sources.assemblies, "assembly").withColumnRenamed("assm_id", "old_id")
    rejects["assemblies_without_project"] = audit.rejected_by_parent(projected, run_map(), "project", "prj_id")
    mapped = remap(projected.withColumnRenamed("prj_id", "prj_ref"), run_map(), "project", "prj_ref", "prj_id", strategy=None)
    keyed = numbered(mapped, "assm_id")
    out["assembly"] = keyed.select(*TARGET_SCHEMAS["assembly"].fieldNames())
    maps.append(crosswalk_rows(keyed, "assembly", new_col="assm_id"))

    # package: one per distinct non-null name
    projected = mapped_projection(sources.src_packages, "package").withColumnRenamed("pkg_id", "old_id")
    named, bounds = projected, None
    if stage is not None:
        named, stats = stage.put(projected, "packages", key_bounds("old_id"))
        bounds = (stats["lo"], stats["hi"])
    mapping, created = get_or_create_by_name(named, empty_target(spark, "package"), materialize=keep, bounds=bounds)
    mapping = keep(mapping)
    out["package"] = created.select(*TARGET_SCHEMAS["package"].fieldNames())
    maps.append(crosswalk_rows(mapping, "package", new_col="pkg_id"))

    # pkg_version: package key through the run's package map
    projected = mapped_projection(sources.pkg_versions, "pkg_version").withColumnRenamed("pkg_vrs_id", "old_id")
    rejects["versions_without_package"] = audit.rejected_by_parent(projected, run_map(), "package", "pkg_id")
    mapped = remap(projected.withColumnRenamed("pkg_id", "src_pkg_ref"), run_map(), "package", "src_pkg_ref", "pkg_id", strategy=None)
    keyed = numbered(mapped, "pkg_vrs_id")
    out["pkg_version"] = keyed.select(*TARGET_SCHEMAS["pkg_version"].fieldNames())
    maps.append(crosswalk_rows(keyed, "pkg_version", new_col="pkg_vrs_id"))

    # assm_pkg_vrs: both ends through the run's maps (every link row, as declared)
    links = mapped_projection(sources.asm_pkg_vsn_lnk, "assm_pkg_vrs").select(
        F.col("assm_id").alias("asm_ref"), F.col("pkg_vrs_id").alias("pkg_vsn_ref")
    )
    both = keep(remap(remap(links, run_map(), "assembly", "asm_ref", "assm_id", "left"), run_map(), "pkg_version", "pkg_vsn_ref", "pkg_vrs_id", "left"))
    rejects["links_with_unmapped_end"] = both.where(F.col("assm_id").isNull() | F.col("pkg_vrs_id").isNull())
    out["assm_pkg_vrs"] = both.where(F.col("assm_id").isNotNull() & F.col("pkg_vrs_id").isNotNull()).select("assm_id", "pkg_vrs_id")

    # changelog: narrow rows first - version key through the run's map, the
    # version's time (0 -> NULL, X8), a new key - then the text and the list of
    # known CVE names (A5) join in once, projected by the declared mapping.
    pv_time = sources.pkg_versions.select(F.col("id").alias("_pv"), F.col("time").alias("_pv_time"))
    narrow = (
        sources.changes.select("id", "pkg_vsn_ref")
        .join(pv_time, F.col("pkg_vsn_ref") == pv_time["_pv"], "left")
        .select(F.col("id").alias("old_id"), "pkg_vsn_ref", C.null_if_zero("_pv_time").alias("_time"))
    )
    rejects["changes_without_version"] = audit.rejected_by_parent(narrow, run_map(), "pkg_version", "pkg_vsn_ref")
    keyed = numbered(remap(narrow, run_map(), "pkg_version", "pkg_vsn_ref", "_new_vrs", strategy=None), "_new_id")
    maps.append(crosswalk_rows(keyed, "changelog", new_col="_new_id"))
    name_col = joined_column("vulnerabilities", "name")
    idents = known_idents_per_change(sources.chg_vln_lnk, sources.vulnerabilities).select(
        F.col("chg_ref").alias("old_id"), F.col("log_ident").alias(name_col)
    )
    text = sources.changes.select(F.col("id").alias("old_id"), "special")
    complete = keyed.join(text, "old_id").join(idents, "old_id", "left").select(
        F.col("old_id").alias("id"),
        "special",
        F.col("_new_vrs").alias("pkg_vsn_ref"),
        F.col("_time").alias(joined_column("pkg_versions", "time")),
        C.text_or_empty(name_col).alias(name_col),
        "_new_id",
        F.col("old_id"),
    )
    projected = mapped_projection(complete, "changelog", keep=("_new_id",))
    out["changelog"] = projected.drop("id").withColumnRenamed("_new_id", "id").select(*TARGET_SCHEMAS["changelog"].fieldNames())

    # urgency: new key per row
    projected = mapped_projection(sources.urgency, "urgency").withColumnRenamed("urg_id", "old_id")
    keyed = numbered(projected, "urg_id")
    out["urgency"] = keyed.select(*TARGET_SCHEMAS["urgency"].fieldNames())
    maps.append(crosswalk_rows(keyed, "urgency", new_col="urg_id"))

    # change-CVE links: report those with an unmapped end, write nothing
    cves = sources.vulnerabilities.where(F.col("name").isNotNull()).select(F.col("id").alias("old_id"), F.col("id").alias("new_id"))
    report_map = union_crosswalks(run_map(), crosswalk_rows(cves, "vulnerabilities"))
    rejects["change_links_unmapped"] = audit.rejected_change_links(sources.chg_vln_lnk, report_map, "changelog", "vulnerabilities")

    return LoadResult(targets=out, crosswalk=run_map(), rejects=rejects, stage=stage)
