"""Fixed schemas of the source catalogue, the tracker catalogue and the targets.

Source integers are 32-bit in the original store; they are read as 64-bit
longs here (epoch seconds in 32 bits end in 2038).  Every column is nullable
except the id of a keyed table.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, S = T.LongType(), T.StringType()
TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- source catalogue (ten tables) -------------------------------------------
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "publishers": _schema(("id", L, False), ("name", S, True)),
    "projects": _schema(
        ("id", L, False), ("name", S, True), ("rls_ref", L, True), ("description", S, True),
        ("pbr_ref", L, True), ("arc_ref", L, True),
    ),
    "assemblies": _schema(
        ("id", L, False), ("time", L, True), ("description", S, True), ("prj_ref", L, True),
        ("pbr_ref", L, True),
    ),
    "src_packages": _schema(("id", L, False), ("name", S, True)),
    "pkg_versions": _schema(
        ("id", L, False), ("time", L, True), ("maintainer", S, True), ("src_pkg_ref", L, True),
        ("version", S, True),
    ),
    "asm_pkg_vsn_lnk": _schema(("asm_ref", L, True), ("pkg_vsn_ref", L, True)),
    "changes": _schema(("id", L, False), ("pkg_vsn_ref", L, True), ("special", S, True)),
    "urgency": _schema(("id", L, False), ("name", S, True)),
    "vulnerabilities": _schema(("id", L, False), ("name", S, True)),
    "chg_vln_lnk": _schema(("chg_ref", L, True), ("vln_ref", L, True)),
}

# Source tables in load order (parents before children).
SOURCE_TABLES: tuple[str, ...] = tuple(SOURCE_SCHEMAS)

# --- second catalogue (vulnerability tracker), ids unrelated to ours ---------
TRACKER_SCHEMAS: dict[str, T.StructType] = {
    "cve": _schema(("cve_id", L, False), ("cve_name", S, True)),
    "cve_rep": _schema(("cve_id", L, True), ("fixed_pkg_vrs_id", L, True)),
    "pkg_version": _schema(("pkg_vrs_id", L, False), ("pkg_id", L, True), ("version", S, True)),
    "package": _schema(("pkg_id", L, False), ("pkg_name", S, True)),
}

# --- targets ------------------------------------------------------------------
TARGET_SCHEMAS: dict[str, T.StructType] = {
    "project": _schema(
        ("prj_id", L, False), ("prj_name", S, True), ("rel_id", L, True), ("prj_desc", S, True),
        ("vendor", S, True), ("arch_id", L, True),
    ),
    "assembly": _schema(
        ("assm_id", L, False), ("assm_date_created", TS, True), ("assm_desc", S, True),
        ("prj_id", L, True), ("assm_version", S, True),
    ),
    "package": _schema(("pkg_id", L, False), ("pkg_name", S, True)),
    "pkg_version": _schema(
        ("pkg_vrs_id", L, False), ("pkg_date_created", TS, True), ("author_name", S, True),
        ("pkg_id", L, True), ("version", S, True),
    ),
    "urgency": _schema(("urg_id", L, False), ("urg_name", S, True)),
    "vulnerabilities": _schema(("id", L, False), ("name", S, True)),
    "assm_pkg_vrs": _schema(("assm_id", L, True), ("pkg_vrs_id", L, True)),
    "changelog": _schema(
        ("id", L, False), ("log_desc", S, True), ("urg_id", L, True), ("pkg_vrs_id", L, True),
        ("date_added", TS, True), ("log_ident", S, True), ("rep_name", S, True),
    ),
    "fixed_cve_status": _schema(
        ("pkg_vrs_id", L, False), ("vulnerability_id", L, False),
        ("changelog_string_number", L, True), ("fixed_tracker_string_number", L, True),
        ("manual_input_user_id", L, True),
    ),
}

# Key column of each target table (unique key for the set-based writes).
TARGET_KEYS: dict[str, tuple[str, ...]] = {
    "project": ("prj_id",),
    "assembly": ("assm_id",),
    "package": ("pkg_name",),
    "pkg_version": ("pkg_id", "version"),
    "urgency": ("urg_id",),
    "vulnerabilities": ("id",),
    "assm_pkg_vrs": ("assm_id", "pkg_vrs_id"),
    "changelog": ("id",),
    "fixed_cve_status": ("pkg_vrs_id", "vulnerability_id"),
}

# Old-to-new key crosswalk; unique on (table_name, old_id).
CROSSWALK_SCHEMA = _schema(("table_name", S, False), ("old_id", L, False), ("new_id", L, False))
