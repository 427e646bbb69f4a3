"""Writers: replace, append, crosswalk append, and write-then-swap.

Spark writes are set-based and partitioned; there are no client-side batches.
A table that is also being read is never overwritten in place: ``write_swap``
writes a sibling folder which then replaces the old one, and the tables that
the jobs load are versions of a ``snapshots.SnapshotStore``.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def write_replace(df: DataFrame, location: str, partition_by: list[str] | None = None) -> None:
    """Replace a table from scratch (S4); staging is never kept."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(location)


def write_append(df: DataFrame, location: str, partition_by: list[str] | None = None) -> None:
    """Append computed rows."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(location)


def write_crosswalk(df: DataFrame, location: str, mode: str = "append") -> None:
    """Write crosswalk rows partitioned by table (S7 append / S8 rebuild).

    Partitioning by ``table_name`` lets the per-table filter of every remap
    prune the scan to one folder.  The rows are rebalanced by table, which
    adaptive execution splits: a table with most of the pairs is written by
    many tasks, a small one by one.
    """
    # A rebuild replaces the whole crosswalk, whatever the session's partition
    # overwrite mode: a table missing from the new pairs must not keep old ones.
    writer = df.hint("rebalance", "table_name").write.mode(mode).partitionBy("table_name")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(location)


def _fs_and_path(spark: SparkSession, location: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(conf), path, jvm


def _siblings(fs, target, jvm, mark: str) -> list:
    pattern = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"{target.getName()}.{mark}_*")
    found = fs.globStatus(pattern)
    return sorted((st.getPath() for st in found or []), key=str)


def recover_swap(spark: SparkSession, location: str) -> bool:
    """Finish a swap that a crash cut short; tells whether the table exists afterwards.

    A missing table means that the crash fell between the two renames: the new
    content, which is complete then, takes the place (or, without one, the old
    content goes back).  Left-over siblings of an existing table are removed.
    """
    fs, target, jvm = _fs_and_path(spark, location.rstrip("/"))
    fresh, retired = (_siblings(fs, target, jvm, mark) for mark in ("__next", "__old"))
    if not fs.exists(target):
        done = [p for p in fresh if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))] if retired else []
        source = done[-1] if done else (retired[-1] if retired else None)
        if source is None:
            for path in fresh:
                fs.delete(path, True)
            return False
        if not fs.rename(source, target):
            raise OSError(f"could not move {source} to {location}")
    for path in (*fresh, *retired):
        if fs.exists(path):
            fs.delete(path, True)
    return True


def write_swap(df: DataFrame, location: str, partition_by: list[str] | None = None) -> None:
    """Write ``df`` to a new sibling folder, then move it over ``location``.

    Safe when ``df`` reads ``location`` itself (an upsert): the read
    completes before anything is removed, because the swap happens only after
    the write job has finished.  A crash between the two renames is mended by
    ``recover_swap``, which readers of a swapped table call first.
    """
    spark = df.sparkSession
    location = location.rstrip("/")
    staged = f"{location}.__next_{uuid.uuid4().hex}"
    write_replace(df, staged, partition_by)
    fs, target, jvm = _fs_and_path(spark, location)
    new_path = jvm.org.apache.hadoop.fs.Path(staged)
    success = jvm.org.apache.hadoop.fs.Path(new_path, "_SUCCESS")
    if not fs.exists(success):  # committers can be set not to write it
        fs.create(success, True).close()
    if fs.exists(target):
        retired = jvm.org.apache.hadoop.fs.Path(f"{location}.__old_{uuid.uuid4().hex}")
        if not fs.rename(target, retired):
            raise OSError(f"could not move {location} aside")
        if not fs.rename(new_path, target):
            fs.rename(retired, target)
            raise OSError(f"could not move {staged} to {location}")
        fs.delete(retired, True)
    elif not fs.rename(new_path, target):
        raise OSError(f"could not move {staged} to {location}")


def observed(obs: Observation) -> dict:
    """An observation's metrics; none if the plan turned out empty and the observed node was dropped from it."""
    try:
        return dict(obs.get)
    except Py4JJavaError as exc:
        if "toPyRow" not in str(exc):  # an observation without a row cannot be converted
            raise
        return {}


class StageArea:
    """Intermediate tables of one run, written under the session's checkpoint folder.

    Writing a step's output as parquet cuts the lineage (later steps and a
    retried task read files, not a chain of joins), gives Catalyst real file
    sizes for its join choices, and survives the loss of an executor.  The
    folder lives under ``spark.checkpoint.dir`` (a shared file system on a
    cluster); ``release()`` removes it once the run's outputs are written.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        root = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = f"{root}/catalink-{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def put(
        self, df: DataFrame, name: str, observe: dict[str, Column] | None = None, partition_by: str | None = None
    ) -> tuple[DataFrame, dict]:
        """Write ``df``; return it read back, plus aggregates observed during the write."""
        self._n += 1
        path = f"{self.root}/{self._n:02d}-{name}"
        obs = None
        if observe:
            obs = Observation(f"{name}-{self._n}")
            df = df.observe(obs, *[col.alias(key) for key, col in observe.items()])
        write_replace(df, path, [partition_by] if partition_by else None)
        stats = dict.fromkeys(observe or {}) | (observed(obs) if obs is not None else {})
        # An empty partitioned write leaves no file to infer a schema from.
        reader = self.spark.read.schema(df.schema) if partition_by else self.spark.read
        return reader.parquet(path), stats

    def release(self) -> None:
        fs, path, _ = _fs_and_path(self.spark, self.root)
        if fs.exists(path):
            fs.delete(path, True)
