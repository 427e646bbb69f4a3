"""Readers for the source catalogue, the tracker catalogue, targets and the crosswalk.

Every reader applies a fixed schema and selects only the schema's columns, so
Catalyst prunes the scan to them (``ReadSchema``) and pushes any later filter
into it.  The same call shape serves parquet, ORC or a JDBC source.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import CROSSWALK_SCHEMA, SOURCE_SCHEMAS, TARGET_SCHEMAS, TRACKER_SCHEMAS


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to its types.

    Missing nullable columns become typed NULLs; a missing non-nullable column
    is an error.
    """
    present = set(df.columns)
    cols: list[Column] = []
    for field in schema.fields:
        if field.name in present:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.nullable:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"column {field.name!r} is required but missing from {df.columns}")
    return df.select(*cols)


def read_table(
    spark: SparkSession,
    location: str,
    schema: T.StructType,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read one table with a fixed schema.

    For ``fmt="jdbc"`` ``location`` is the ``dbtable`` (a table name or a
    sub-query), and ``options`` carry url/user/partitioning settings; the
    select below is then pushed into the remote query.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "jdbc":
        df = reader.option("dbtable", location).load()
    else:
        df = reader.schema(schema).load(location)
    return conform(df, schema)


def key_ranges(key: str, lo: int | None, hi: int | None, n: int) -> list[str]:
    """Predicates that split a table into at most ``n`` ranges of an integer key, each row in exactly one.

    The outer ranges are open, so rows that arrive outside of the bounds after
    these were found are read too, and the first takes rows without a key.
    """
    if lo is None or hi is None or n < 2 or hi == lo:
        return ["1 = 1"]
    cuts = sorted({lo + (hi - lo + 1) * k // n for k in range(1, n)} - {lo})
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


def read_jdbc_split(
    spark: SparkSession, table: str, schema: T.StructType, key: str, n: int, options: dict[str, str]
) -> DataFrame:
    """S1, S2 from a database: one query finds the key's bounds, then ``n`` tasks read a range each.

    ``options`` carry url, driver and user.  Not run here, as no JDBC driver is
    installed; the ranges are tested.
    """
    bounds = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**options).option("query", bounds).load().first()
    lo, hi = (None if v is None else int(v) for v in (row[0], row[1]))
    rest = {k: v for k, v in options.items() if k != "url"}
    df = spark.read.jdbc(options["url"], table, predicates=key_ranges(key, lo, hi, n), properties=rest)
    return conform(df, schema)


@dataclass(frozen=True)
class SourceCatalogue:
    """The ten source tables (typed DataFrames)."""

    publishers: DataFrame
    projects: DataFrame
    assemblies: DataFrame
    src_packages: DataFrame
    pkg_versions: DataFrame
    asm_pkg_vsn_lnk: DataFrame
    changes: DataFrame
    urgency: DataFrame
    vulnerabilities: DataFrame
    chg_vln_lnk: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]

    def replace(self, **frames: DataFrame) -> "SourceCatalogue":
        return replace(self, **frames)


@dataclass(frozen=True)
class TrackerCatalogue:
    """The tracker's four tables (ids unrelated to the source catalogue)."""

    cve: DataFrame
    cve_rep: DataFrame
    pkg_version: DataFrame
    package: DataFrame


def read_sources(
    spark: SparkSession, base: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> SourceCatalogue:
    """Read the ten source tables from ``{base}/{table}`` (or JDBC tables)."""
    sep = "." if fmt == "jdbc" else "/"
    frames = {
        name: read_table(spark, f"{base}{sep}{name}", schema, fmt, options)
        for name, schema in SOURCE_SCHEMAS.items()
    }
    return SourceCatalogue(**frames)


def read_tracker(
    spark: SparkSession, base: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> TrackerCatalogue:
    sep = "." if fmt == "jdbc" else "/"
    frames = {
        name: read_table(spark, f"{base}{sep}{name}", schema, fmt, options)
        for name, schema in TRACKER_SCHEMAS.items()
    }
    return TrackerCatalogue(**frames)


def read_target(
    spark: SparkSession, location: str, table: str, fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    return read_table(spark, location, TARGET_SCHEMAS[table], fmt, options)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed empty frame (planned as an empty relation, no driver-side data)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty_target(spark: SparkSession, table: str) -> DataFrame:
    return empty_frame(spark, TARGET_SCHEMAS[table])


def empty_crosswalk(spark: SparkSession) -> DataFrame:
    return empty_frame(spark, CROSSWALK_SCHEMA)


def read_crosswalk(spark: SparkSession, location: str | None) -> DataFrame:
    """Read the saved crosswalk (S6); a missing one is empty.

    The crosswalk is written partitioned by ``table_name``, so filtering one
    table prunes the scan to its folder.
    """
    if not location:
        return empty_crosswalk(spark)
    try:
        df = spark.read.schema(CROSSWALK_SCHEMA).parquet(location)
    except Exception as exc:  # noqa: BLE001 - only "path does not exist" is expected
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return empty_crosswalk(spark)
        raise
    return conform(df, CROSSWALK_SCHEMA)
