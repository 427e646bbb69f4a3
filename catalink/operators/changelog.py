"""Changelog rows and their CVE identifier lists.

Plan shape: the identifier list is built from the link table alone (links
joined with CVE names, grouped by change) and then joined to the changes,
so the change text is never carried through the grouping shuffle.  Names are
sorted inside each list (the original left the order undefined, R15).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from .crosswalk import for_table

# Fixed value: separator between CVE names in a change's identifier list.
SEPARATOR = ", "


def _names(vulnerabilities: DataFrame) -> DataFrame:
    return vulnerabilities.select(F.col("id").alias("vln_ref"), F.col("name").alias("_vname"))


def idents_per_change(chg_vln_lnk: DataFrame, vulnerabilities: DataFrame) -> DataFrame:
    """A4 + J7: ``(chg_ref, log_ident)``: CVE names of a change joined by ', '.

    Left join semantics: links to unknown CVE ids or NULL names contribute
    nothing; repeats are kept.  ``collect_list`` aggregates partially per
    task before the shuffle.  The list of one change is, by definition, held
    in one row of the result.
    """
    joined = chg_vln_lnk.join(_names(vulnerabilities), "vln_ref", "left")
    return joined.groupBy("chg_ref").agg(
        F.array_join(F.array_sort(F.collect_list("_vname")), SEPARATOR).alias("log_ident")
    )


def known_idents_per_change(chg_vln_lnk: DataFrame, vulnerabilities: DataFrame) -> DataFrame:
    """A5 + A11 + X12: only links whose CVE id is known (inner join), with their count."""
    joined = chg_vln_lnk.join(
        _names(vulnerabilities).where(F.col("_vname").isNotNull()), "vln_ref"
    )
    return joined.groupBy("chg_ref").agg(
        F.array_join(F.array_sort(F.collect_list("_vname")), SEPARATOR).alias("log_ident"),
        F.count(F.lit(1)).alias("n_known"),
    )


def attach_idents(changes: DataFrame, idents: DataFrame, key: str = "id") -> DataFrame:
    """Left join the lists back to every change; no links -> ''."""
    out = changes.join(idents.withColumnRenamed("chg_ref", "_chg"), changes[key] == F.col("_chg"), "left").drop("_chg")
    return out.withColumn("log_ident", C.text_or_empty("log_ident"))


def version_lookup(crosswalk: DataFrame, pkg_versions: DataFrame) -> DataFrame:
    """``(old version id, new version id, time)``: both lookups a change needs, in one table.

    Joining the crosswalk pairs with the staged versions first means the big
    changes table is shuffled once (J2 + J16 share the key ``pkg_vsn_ref``).
    """
    pairs = for_table(crosswalk, "pkg_versions")
    return pairs.join(pkg_versions.select(F.col("id").alias("old_id"), "time").hint("merge"), "old_id").select(
        F.col("old_id").alias("_pv_old"), F.col("new_id").alias("pkg_vrs_id"), F.col("time").alias("_pv_time")
    )


def changelog_versions(
    changes: DataFrame,
    crosswalk: DataFrame,
    pkg_versions: DataFrame,
    run_ts: dt.datetime | str,
    zero_is_null: bool = True,
    how: str = "inner",
) -> DataFrame:
    """Narrow changelog rows ``(old_id, pkg_vrs_id, date_added)`` - no text.

    Changes whose version is unmapped are dropped (inner join, as the source
    query does) or, with ``how="left"``, kept without a version, beside their
    ``pkg_vsn_ref``, for a reject frame.  ``zero_is_null=True`` is X5 (incremental load), ``False`` is
    X6 (full load: only a NULL time becomes the load time).  Keeping the text
    out of this step means the joins and the key numbering shuffle ids only.
    """
    lookup = version_lookup(crosswalk, pkg_versions).hint("merge")
    base = changes.select("id", "pkg_vsn_ref").join(lookup, F.col("pkg_vsn_ref") == lookup["_pv_old"], how)
    return base.select(
        F.col("id").alias("old_id"),
        *(["pkg_vsn_ref"] if how == "left" else []),
        "pkg_vrs_id",
        C.epoch_or_load_time("_pv_time", run_ts, zero_is_null).alias("date_added"),
    )


def with_text(rows: DataFrame, changes: DataFrame, idents: DataFrame | None = None) -> DataFrame:
    """Complete narrow (keyed) rows with the change text and the CVE list.

    The text joins in once, by change id; when ``rows`` is small (a typical
    incremental run) AQE broadcasts it and the text is not shuffled at all.
    Without ``idents`` the identifier column is '' (the incremental load
    leaves it empty).
    """
    text = changes.select(F.col("id").alias("old_id"), C.text_or_empty("special").alias("log_desc"))
    out = rows.join(text, "old_id").withColumn("urg_id", F.lit(None).cast("long")).withColumn(
        "rep_name", F.lit(None).cast("string")
    )
    if idents is None:
        return out.withColumn("log_ident", F.lit(C.EMPTY))
    return attach_idents(out, idents, key="old_id")
