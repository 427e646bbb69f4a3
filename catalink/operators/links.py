"""Link tables: remap both ends, keep only new pairs.

The link table is the largest input (builds x versions).  Each end is
remapped with one join against that table's crosswalk pairs; AQE broadcasts
a side that turns out small at runtime and splits a skewed partition (a
version used by a third of all builds) otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crosswalk import remap
from .key_filter import key_filter, may_hold

# A target at least so many times larger than the delta is filtered by the delta's keys before it is shuffled.
FILTER_RATIO = 8


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: for a scan of files the bytes of its columns; joins only make it larger."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def remap_links(
    links: DataFrame,
    crosswalk: DataFrame,
    left: tuple[str, str, str] = ("asm_ref", "assemblies", "assm_id"),
    right: tuple[str, str, str] = ("pkg_vsn_ref", "pkg_versions", "pkg_vrs_id"),
    how: str = "inner",
) -> DataFrame:
    """New ids for both ends; ``how="inner"`` drops links with an unmapped end."""
    ref_l, table_l, out_l = left
    ref_r, table_r, out_r = right
    out = remap(links, crosswalk, table_l, ref_l, out_l, how)
    return remap(out, crosswalk, table_r, ref_r, out_r, how)


def new_links_only(remapped: DataFrame, existing: DataFrame, cols: tuple[str, str] = ("assm_id", "pkg_vrs_id")) -> DataFrame:
    """J6 + R11: distinct pairs not yet in ``existing``.

    De-duplicating first repairs a ``NOT EXISTS`` that only sees earlier
    statements (repeats inside one batch would pass); the distinct is a
    partial aggregate, so repeated pairs collapse before the shuffle.  Of an
    ``existing`` much larger than the delta only the rows that a Bloom filter of
    the delta's pairs lets pass are shuffled; the result is the same.
    """
    delta, known = remapped.select(*cols), existing.select(*cols)
    if plan_bytes(delta) * FILTER_RATIO <= plan_bytes(known):
        known = may_hold(known, cols, key_filter(delta, cols))
    return delta.distinct().join(known.hint("merge"), list(cols), "left_anti")


def mapped_links(links: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Every link with its mapped ids (NULL where unmapped): one remap for rows and rejects."""
    return remap_links(links, crosswalk, how="left")


def both_ends(mapped: DataFrame) -> DataFrame:
    """The links of ``mapped_links`` with both ends mapped."""
    return mapped.where(F.col("assm_id").isNotNull() & F.col("pkg_vrs_id").isNotNull())


def unmapped_end(mapped: DataFrame) -> DataFrame:
    """F5 + J8: the links of ``mapped_links`` with an unmapped end."""
    return mapped.where(F.col("assm_id").isNull() | F.col("pkg_vrs_id").isNull())


def links_with_unmapped_end(links: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """F5 + J8 in one step."""
    return unmapped_end(mapped_links(links, crosswalk))
