"""Crosswalk operators: remap, delta, merge, sizes, rebuild.

The crosswalk is one DataFrame ``(table_name, old_id, new_id)`` unique on
``(table_name, old_id)``.  It is never turned into a driver dict: every lookup
is a join, and the per-table filter is pushed into the scan (the saved
crosswalk is partitioned by ``table_name``).

Lookups that grow with the catalogue carry a ``merge`` hint.  Catalyst sizes a
scan by its file bytes, and ordered ids fill fifty times that as broadcast
rows: without the hint every step sends a table's pairs through the driver
until their file passes the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import max_value


def for_table(crosswalk: DataFrame, table: str) -> DataFrame:
    """The ``old_id -> new_id`` pairs of one table."""
    return crosswalk.where(F.col("table_name") == F.lit(table)).select("old_id", "new_id")


def remap(
    df: DataFrame,
    crosswalk: DataFrame,
    table: str,
    ref_col: str,
    out_col: str,
    how: str = "inner",
    strategy: str | None = "merge",
) -> DataFrame:
    """Add ``out_col`` = new id of ``ref_col`` in ``table``.

    ``how="inner"`` drops rows whose reference is unmapped (the reference's
    behaviour); ``how="left"`` keeps them with NULL (for audits and reject
    frames).  A hot parent (one project owning a third of all assemblies) is
    split by AQE's skew-join handling; the crosswalk side is unique per key,
    so no row fan-out can happen.  ``strategy=None`` leaves the join to Catalyst.
    """
    pairs = for_table(crosswalk, table).withColumnRenamed("old_id", "_xw_old").withColumnRenamed("new_id", out_col)
    if strategy:
        pairs = pairs.hint(strategy)
    return df.join(pairs, df[ref_col] == pairs["_xw_old"], how).drop("_xw_old")


def unmapped(df: DataFrame, crosswalk: DataFrame, table: str, ref_col: str) -> DataFrame:
    """F7 reject frame: rows whose ``ref_col`` has no mapping in ``table``."""
    pairs = for_table(crosswalk, table).select(F.col("old_id").alias("_xw_old")).hint("merge")
    return df.join(pairs, df[ref_col] == pairs["_xw_old"], "left_anti")


def only_new(df: DataFrame, crosswalk: DataFrame, table: str, key_col: str = "old_id") -> DataFrame:
    """Rows whose own key is not in the crosswalk yet (the delta)."""
    return unmapped(df, crosswalk, table, key_col)


def merge_crosswalk(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Add new pairs, keep every existing one (``ON CONFLICT DO NOTHING``)."""
    fresh = new.join(existing.select("table_name", "old_id").hint("merge"), ["table_name", "old_id"], "left_anti")
    return existing.select("table_name", "old_id", "new_id").unionByName(fresh.select("table_name", "old_id", "new_id"))


def max_new_id(crosswalk: DataFrame, table: str) -> int:
    """Largest key already handed out for ``table`` (0 when none)."""
    return max_value(for_table(crosswalk, table), "new_id")


def crosswalk_sizes(crosswalk: DataFrame) -> DataFrame:
    """Number of pairs per table."""
    return crosswalk.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_mappings"))


# Fixed value: the key column of each target that has one of its own.
TARGET_KEY_COLUMNS = {
    "project": "prj_id",
    "assembly": "assm_id",
    "package": "pkg_id",
    "pkg_version": "pkg_vrs_id",
    "changelog": "id",
    "urgency": "urg_id",
    "vulnerabilities": "id",
}


def crosswalk_from_targets(targets: dict[str, DataFrame]) -> DataFrame:
    """K7: rebuild pairs from loaded targets, each table's own key mapped to itself.

    The targets no longer hold the source ids, hence old = new.  The key is
    named per table (repairing a choice by column order, which took a foreign
    key for the assembly and the version), so pairs stay unique on
    ``(table_name, old_id)``.
    """
    frames = []
    for table, df in targets.items():
        key = F.col(TARGET_KEY_COLUMNS[table]).cast("long")
        frames.append(df.select(F.lit(table).alias("table_name"), key.alias("old_id"), key.alias("new_id")))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
