"""Staging and cleaning projections.

Each function is a single narrow ``select`` (or one join for the vendor), so
it fuses into the scan's whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean as C
from ..sources.schemas import TARGET_SCHEMAS


def projects_with_vendor(projects: DataFrame, publishers: DataFrame) -> DataFrame:
    """J1 + S3: stage projects with their publisher's name as ``vendor``.

    Inner join: a project whose publisher is missing is dropped, as in the
    source query (``rejected_projects`` gives those rows).
    """
    pubs = publishers.select(F.col("id").alias("_pub_id"), F.col("name").alias("vendor"))
    return projects.join(pubs, projects["pbr_ref"] == pubs["_pub_id"]).select(
        F.col("id").alias("old_id"), "name", "rls_ref", "description", "vendor", "arc_ref"
    )


def rejected_projects(projects: DataFrame, publishers: DataFrame) -> DataFrame:
    """R17 reject frame: projects whose publisher is missing."""
    return projects.join(publishers.select(F.col("id").alias("pbr_ref")), "pbr_ref", "left_anti")


def clean_projects(staged: DataFrame) -> DataFrame:
    """X1 + X2: target ``project`` columns (plus ``old_id``)."""
    return staged.select(
        "old_id",
        C.or_default("name", C.UNKNOWN).alias("prj_name"),
        C.null_if_zero("rls_ref").alias("rel_id"),
        F.col("description").alias("prj_desc"),
        C.or_default("vendor", C.UNKNOWN).alias("vendor"),
        C.null_if_zero("arc_ref").alias("arch_id"),
    )


def clean_assemblies(assemblies: DataFrame, run_ts: dt.datetime | str, zero_is_null: bool = True) -> DataFrame:
    """X5 + X1 + P3: target ``assembly`` columns (plus ``old_id``, ``prj_ref``)."""
    return assemblies.select(
        F.col("id").alias("old_id"),
        C.epoch_or_load_time("time", run_ts, zero_is_null).alias("assm_date_created"),
        C.or_default("description", C.NO_DESCRIPTION).alias("assm_desc"),
        "prj_ref",
        F.lit(C.ASSEMBLY_VERSION).alias("assm_version"),
    )


def clean_pkg_versions(pkg_versions: DataFrame, run_ts: dt.datetime | str, zero_is_null: bool = True) -> DataFrame:
    """X5 + X3 + X4: target ``pkg_version`` columns (plus ``old_id``, ``src_pkg_ref``)."""
    return pkg_versions.select(
        F.col("id").alias("old_id"),
        C.epoch_or_load_time("time", run_ts, zero_is_null).alias("pkg_date_created"),
        C.null_if_empty("maintainer").alias("author_name"),
        "src_pkg_ref",
        C.version_or_default("version").alias("version"),
    )


def missing_time_sample(assemblies: DataFrame, n: int = 5) -> DataFrame:
    """F4 + O2: the first ``n`` assemblies (by id) whose time is 0 or NULL.

    The limit is the feature here (a sample for the log); ordering makes it
    repeatable.  ``orderBy().limit()`` runs as a top-k per task.
    """
    return (
        assemblies.where(C.time_missing("time"))
        .select(F.col("id").alias("old_id"), "time")
        .orderBy("old_id")
        .limit(n)
    )


# Declared mapping of target columns to (source table, source
# column); None means "insert NULL".
DECLARED_MAPPING: dict[str, dict[str, tuple[str, str] | None]] = {
    "project": {
        "prj_id": ("projects", "id"),
        "prj_name": ("projects", "name"),
        "rel_id": ("projects", "rls_ref"),
        "prj_desc": ("projects", "description"),
        "vendor": ("publishers", "name"),
        "arch_id": ("projects", "arc_ref"),
    },
    "assembly": {
        "assm_id": ("assemblies", "id"),
        "assm_date_created": ("assemblies", "time"),
        "assm_desc": ("assemblies", "description"),
        "prj_id": ("assemblies", "prj_ref"),
        "assm_version": None,
    },
    "package": {
        "pkg_id": ("src_packages", "id"),
        "pkg_name": ("src_packages", "name"),
    },
    "pkg_version": {
        "pkg_vrs_id": ("pkg_versions", "id"),
        "pkg_date_created": ("pkg_versions", "time"),
        "author_name": ("pkg_versions", "maintainer"),
        "pkg_id": ("pkg_versions", "src_pkg_ref"),
        "version": ("pkg_versions", "version"),
    },
    "assm_pkg_vrs": {
        "pkg_vrs_id": ("asm_pkg_vsn_lnk", "pkg_vsn_ref"),
        "assm_id": ("asm_pkg_vsn_lnk", "asm_ref"),
    },
    "changelog": {
        "id": ("changes", "id"),
        "log_desc": ("changes", "special"),
        "urg_id": None,
        "pkg_vrs_id": ("changes", "pkg_vsn_ref"),
        "date_added": ("pkg_versions", "time"),
        "log_ident": ("vulnerabilities", "name"),
        "rep_name": None,
    },
    "urgency": {
        "urg_id": ("urgency", "id"),
        "urg_name": ("urgency", "name"),
    },
}

# Source table each target is read from (the others come in through joins).
MAPPING_BASE: dict[str, str] = {
    "project": "projects",
    "assembly": "assemblies",
    "package": "src_packages",
    "pkg_version": "pkg_versions",
    "assm_pkg_vrs": "asm_pkg_vsn_lnk",
    "changelog": "changes",
    "urgency": "urgency",
}


def joined_column(table: str, column: str) -> str:
    """Name under which a column of a joined (non-base) table is expected."""
    return f"{table}__{column}"


def mapped_projection(df: DataFrame, target: str, mapping: dict | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto a target table by the declared mapping.

    Columns of the base table are taken by their own name; columns of other
    tables must already be joined in as ``{table}__{column}``.  A ``None``
    entry gives a typed NULL (P2).  Values are cast to the target's types;
    an epoch-seconds source for a timestamp target is converted with X7
    (NULL stays NULL, 0 is 1970).  ``keep`` columns are passed through as they are.
    """
    mapping = mapping or DECLARED_MAPPING[target]
    base = MAPPING_BASE[target]
    schema = TARGET_SCHEMAS[target]
    cols = []
    for name, source in mapping.items():
        dtype = schema[name].dataType
        if source is None:
            cols.append(F.lit(None).cast(dtype).alias(name))
            continue
        table, column = source
        col = F.col(column) if table == base else F.col(joined_column(table, column))
        if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
            col = C.epoch_to_ts(col)
        cols.append(col.cast(dtype).alias(name))
    return df.select(*cols, *keep)
