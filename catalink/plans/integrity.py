"""Integrity report (W5): counts and checks before and after a load.

One ``(check_name, value)`` row per check; every value is a global aggregate
(partial per task), so nothing but these rows reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import time_missing
from ..operators import audit
from ..operators.projection import projects_with_vendor
from ..sources.catalog import SourceCatalogue


def _rows(df: DataFrame) -> DataFrame:
    """Turn a one-row frame of counts into ``(check_name, value)`` rows."""
    return df.unpivot([], df.columns, "check_name", "value").select(
        "check_name", F.col("value").cast("long").alias("value")
    )


def integrity_report(sources: SourceCatalogue, crosswalk: DataFrame) -> DataFrame:
    staged_projects = projects_with_vendor(sources.projects, sources.publishers)
    assemblies = sources.assemblies.agg(
        F.count(F.lit(1)).alias("assemblies"),
        F.count_if(time_missing("time")).alias("assemblies_time_missing"),
    )
    versions = sources.pkg_versions.agg(F.count(F.lit(1)).alias("pkg_versions"))
    orphan_prj = audit.orphan_refs(sources.assemblies, "prj_ref", staged_projects, "old_id", "x").select(
        F.col("distinct_refs").alias("assemblies_missing_project_refs"),
        F.col("n_rows").alias("assemblies_missing_project_rows"),
    )
    orphan_pkg = audit.orphan_refs(sources.pkg_versions, "src_pkg_ref", sources.src_packages, "id", "x").select(
        F.col("distinct_refs").alias("versions_missing_package_refs"),
        F.col("n_rows").alias("versions_missing_package_rows"),
    )
    links = audit.link_audit(sources.asm_pkg_vsn_lnk, crosswalk).select(
        "total_links",
        F.col("missing_assemblies").alias("links_missing_assembly"),
        F.col("missing_versions").alias("links_missing_version"),
    )
    out = _rows(assemblies)
    for frame in (versions, orphan_prj, orphan_pkg, links):
        out = out.unionByName(_rows(frame))
    return out
