"""Intermediate tables of the operators, written under the session's checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import StageArea, _fs_and_path

# Spark's own setting: a finished execution removes its shuffle files.  What it wrote stands for them.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """Written tables of one run of an operator.

    Writing a step's result cuts the lineage: later steps and retried tasks
    read files, whatever executors are lost.  A step's shuffle files go when
    it has been written, and ``drop`` removes tables that no later step reads,
    so that a run holds little more than its current step on disk.  The rest
    goes when the driver process ends, as the operators return lazy frames
    that read it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.area = StageArea(spark, label)
        self.paths: dict[str, str] = {}
        atexit.register(self._release)

    def _release(self) -> None:
        # The session may be gone by then; its folder is the cluster's to clean.
        with contextlib.suppress(Py4JError, OSError, AttributeError):
            self.area.release()

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back."""
        before = self.spark.conf.get(CLEAN_SHUFFLES, None)
        self.spark.conf.set(CLEAN_SHUFFLES, "true")
        try:
            path = f"{self.area.root}/{len(self.paths):03d}-{name}"
            df.write.mode("overwrite").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(CLEAN_SHUFFLES)
            else:
                self.spark.conf.set(CLEAN_SHUFFLES, before)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path, _ = _fs_and_path(self.spark, self.paths[name])
            fs.delete(path, True)


def stage_area(spark: SparkSession, label: str) -> Tables:
    return Tables(spark, label)


def put(area: Tables, df: DataFrame, name: str) -> DataFrame:
    return area.put(df, name)
