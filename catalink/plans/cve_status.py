"""CVE fix status (W4): evidence from changelog text and the tracker, merged into the table.

``fix_status_rows`` computes the rows to upsert; ``merge_fix_status`` applies
them with first-non-null-wins semantics; ``run_fix_status`` reads the saved
table, merges and replaces it by write-then-swap, and returns the number of
incoming rows (counted while staging, not by a second scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evidence import cve_fix_status, repo_versions
from ..operators.merge import upsert_first_non_null
from ..sources.catalog import TrackerCatalogue, conform, empty_target, read_target
from ..sources.schemas import TARGET_KEYS, TARGET_SCHEMAS
from ..sources.sinks import StageArea, recover_swap, write_swap
from ..sources.snapshots import Buckets, Commit, upsert_buckets

STATUS = "fixed_cve_status"
# Buckets of a new fix-status table; a table keeps the number it was made with.
STATUS_BUCKETS = 64

NUMBERS = ("changelog_string_number", "fixed_tracker_string_number")


def fix_status_rows(
    pkg_version: DataFrame,
    package: DataFrame,
    assm_pkg_vrs: DataFrame,
    changelog: DataFrame,
    vulnerabilities: DataFrame,
    tracker: TrackerCatalogue,
) -> DataFrame:
    """Rows for ``fixed_cve_status`` from the repository's target tables (user id NULL)."""
    rows = cve_fix_status(
        repo_versions(pkg_version, package), assm_pkg_vrs, changelog, vulnerabilities, tracker
    )
    return rows.withColumn("manual_input_user_id", F.lit(None).cast("long"))


def merge_fix_status(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """First non-null number wins; ``manual_input_user_id`` keeps the existing value."""
    merged = upsert_first_non_null(
        existing, incoming, TARGET_KEYS["fixed_cve_status"], NUMBERS, ("manual_input_user_id",)
    )
    return conform(merged, TARGET_SCHEMAS["fixed_cve_status"])


def run_fix_status(
    spark: SparkSession,
    table_location: str,
    incoming: DataFrame,
    existing: DataFrame | None = None,
) -> int:
    """Merge ``incoming`` into the table at ``table_location`` and replace it.

    A swap that an earlier run did not finish is mended first, so a table that
    a crash moved aside is never taken for an empty one.  ``incoming`` is
    computed once: staged, and counted while it is written.
    """
    found = recover_swap(spark, table_location)
    if existing is None:
        existing = read_target(spark, table_location, "fixed_cve_status") if found else empty_target(spark, "fixed_cve_status")
    stage = StageArea(spark, "fix-status")
    try:
        staged, seen = stage.put(incoming, "incoming", {"rows": F.count(F.lit(1))})
        rows = int(seen.get("rows") or 0)
        if rows:  # S10: else nothing to merge, the table stays as it is
            write_swap(merge_fix_status(existing, staged), table_location)
        return rows
    finally:
        stage.release()


def upsert_fix_status(commit: Commit, incoming: DataFrame, n_buckets: int = STATUS_BUCKETS) -> tuple[int, list[int]]:
    """S9 on the snapshot table: only buckets with incoming keys are rewritten; returns incoming rows and those buckets."""
    known = commit.base.tables.get(STATUS)
    buckets = known.buckets if known and known.buckets else Buckets(tuple(TARGET_KEYS[STATUS]), n_buckets)
    stage = StageArea(incoming.sparkSession, "fix-status")
    try:
        staged, _ = stage.put(incoming, "incoming")
        rows = staged.count()
        touched = upsert_buckets(commit, STATUS, staged, TARGET_SCHEMAS[STATUS], buckets, merge_fix_status) if rows else []
        return rows, touched
    finally:
        stage.release()
