"""End-to-end jobs over folders: read sources, run a flow, write targets, crosswalk and rejects.

Folder layout (any Hadoop file system):

* ``{sources}/{table}``  - the ten source tables (parquet), or JDBC tables;
* ``{targets}``          - a ``SnapshotStore``: target tables, the crosswalk
  ``_id_mappings`` (bucketed by old id), the bucketed ``fixed_cve_status`` and
  ``_rejects/{name}``, the rows a step could not load, per run.

A load writes everything aside and publishes it by one manifest: readers see all
of it or nothing, and of two loads that started from the same version the second
starts again from the new one, so that keys are handed out once.  Counts are read
from the written files' footers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.bucketed import read_bucketed_crosswalk, write_bucketed_crosswalk
from ..sources.catalog import SourceCatalogue, read_tracker
from ..sources.schemas import CROSSWALK_SCHEMA, TARGET_SCHEMAS
from ..sources.sinks import write_replace
from ..sources.snapshots import Commit, CommitConflict, Snapshot, SnapshotStore, file_row_counts
from ..operators import evidence as ev
from .cve_status import STATUS, fix_status_rows, run_fix_status, upsert_fix_status
from .integrity import integrity_report
from .load import LoadResult, full_load, incremental_load
from .mapped_load import mapped_load

CROSSWALK_DIR = "_id_mappings"
REJECTS_DIR = "_rejects"
# How often a load starts again when another one publishes first.
ATTEMPTS = 3


def read_loaded(spark: SparkSession, targets: str, table: str, snapshot: Snapshot | None = None) -> DataFrame:
    """A target table as of the newest (or a given) snapshot."""
    return SnapshotStore(spark, targets).read(table, TARGET_SCHEMAS[table], snapshot)


def read_rejects(spark: SparkSession, targets: str, name: str) -> DataFrame:
    """The reject frame of the last run that wrote it."""
    return spark.read.parquet(*SnapshotStore(spark, targets).folders(f"{REJECTS_DIR}/{name}"))


def read_loaded_crosswalk(spark: SparkSession, targets: str, snapshot: Snapshot | None = None) -> DataFrame:
    """The saved crosswalk, bucketed by old id; a missing one is empty."""
    return read_bucketed_crosswalk(spark, SnapshotStore(spark, targets).folders(CROSSWALK_DIR, snapshot))


def _write_rejects(commit: Commit, rejects: dict[str, DataFrame]) -> dict[str, tuple[str, T.StructType]]:
    written = {}
    for name, df in rejects.items():
        table = f"{REJECTS_DIR}/{name}"
        write_replace(df, commit.path(table))
        commit.replace(table)
        written[f"reject:{name}"] = (commit.path(table), df.schema)
    return written


def _publish(spark: SparkSession, commit: Commit, result: LoadResult, append: bool) -> dict[str, int]:
    done = False
    try:
        written: dict[str, tuple[str, T.StructType]] = {}
        for table, df in result.targets.items():
            write_replace(df, commit.path(table))
            (commit.append if append else commit.replace)(table)
            written[table] = (commit.path(table), df.schema)
        write_bucketed_crosswalk(result.crosswalk, commit.path(CROSSWALK_DIR))
        (commit.append if append else commit.replace)(CROSSWALK_DIR)
        written["id_mappings"] = (commit.path(CROSSWALK_DIR), CROSSWALK_SCHEMA)
        written |= _write_rejects(commit, result.rejects)
        counts = file_row_counts(spark, written)
        commit.publish()
        done = True
        return counts
    finally:
        result.release()
        if not done:
            commit.abandon()


def _retried(run: Callable[[], dict[str, int]], attempts: int) -> dict[str, int]:
    """Start again, from the newest snapshot, when another run published first."""
    for left in range(attempts - 1, -1, -1):
        try:
            return run()
        except CommitConflict:
            if not left:
                raise
    raise ValueError("at least one attempt is needed")


def run_full_load(
    spark: SparkSession, sources: SourceCatalogue, targets: str, run_ts: dt.datetime | str, attempts: int = ATTEMPTS
) -> dict[str, int]:
    """Replace every target table and the crosswalk."""
    store = SnapshotStore(spark, targets)
    return _retried(lambda: _publish(spark, store.begin(), full_load(sources, run_ts), append=False), attempts)


def run_incremental_load(
    spark: SparkSession, sources: SourceCatalogue, targets: str, run_ts: dt.datetime | str, attempts: int = ATTEMPTS
) -> dict[str, int]:
    """Append rows missing from the crosswalk; a first run starts from empty targets."""
    store = SnapshotStore(spark, targets)

    def run() -> dict[str, int]:
        commit = store.begin()
        existing = {
            table: store.read(table, TARGET_SCHEMAS[table], commit.base)
            for table in TARGET_SCHEMAS
            if table != STATUS and table in commit.base.tables
        }
        crosswalk = read_loaded_crosswalk(spark, targets, commit.base)
        return _publish(spark, commit, incremental_load(sources, run_ts, existing, crosswalk), append=True)

    return _retried(run, attempts)


def run_mapped_load(spark: SparkSession, sources: SourceCatalogue, targets: str, attempts: int = ATTEMPTS) -> dict[str, int]:
    """Load by the declared mapping, replacing the targets."""
    store = SnapshotStore(spark, targets)
    return _retried(lambda: _publish(spark, store.begin(), mapped_load(sources), append=False), attempts)


def run_cve_fix_status(
    spark: SparkSession, targets: str, tracker_base: str, table: str | None = None, attempts: int = ATTEMPTS
) -> dict[str, int]:
    """Merge fix evidence into ``fixed_cve_status``, a bucketed table of the targets (or the folder ``table``).

    Returns the rows merged (``fixed_cve_status``), the changelog rows in
    scope, and the CVE names either side mentions that the CVE table does not
    know, which are written as rejects (F8) and published with the table.
    """
    store = SnapshotStore(spark, targets)

    def run() -> dict[str, int]:
        commit = store.begin()
        t = {name: store.read(name, TARGET_SCHEMAS[name], commit.base)
             for name in ("pkg_version", "package", "assm_pkg_vrs", "changelog", "vulnerabilities")}
        tracker = read_tracker(spark, tracker_base)
        incoming = fix_status_rows(
            t["pkg_version"], t["package"], t["assm_pkg_vrs"], t["changelog"], t["vulnerabilities"], tracker
        )
        rows = run_fix_status(spark, table, incoming) if table else upsert_fix_status(commit, incoming)[0]
        built = ev.versions_in_builds(ev.repo_versions(t["pkg_version"], t["package"]), t["assm_pkg_vrs"])
        rejects = {
            "log_unknown_cves": ev.unknown_mentions(ev.change_mentions(t["changelog"]), t["vulnerabilities"], t["assm_pkg_vrs"]),
            "tracker_unknown_cves": ev.tracker_unknown_cves(
                tracker, ev.repo_version_key(built), ev.cve_ids_by_name(t["vulnerabilities"])
            ),
        }
        counts = {STATUS: rows, "changes_in_scope": ev.count_in_scope(t["changelog"], t["assm_pkg_vrs"]).first()["n_changes"]}
        counts |= file_row_counts(spark, _write_rejects(commit, rejects))
        commit.publish()
        return counts

    return _retried(run, attempts)


def run_integrity_report(spark: SparkSession, sources: SourceCatalogue, targets: str) -> DataFrame:
    """Checks over the sources and the saved crosswalk."""
    return integrity_report(sources, read_loaded_crosswalk(spark, targets))


__all__ = [
    "read_loaded",
    "read_loaded_crosswalk",
    "read_rejects",
    "run_cve_fix_status",
    "run_full_load",
    "run_incremental_load",
    "run_integrity_report",
    "run_mapped_load",
]
