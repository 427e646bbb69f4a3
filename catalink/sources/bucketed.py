"""The crosswalk bucketed and sorted by old id, so that joins on it do not shuffle it.

A folder is written as a Spark bucketed table, one file per bucket and
``table_name``; it needs no metastore afterwards: the reader describes the
folders of a snapshot to the session's catalogue, a partition each.  A remap or
an anti join on ``old_id`` then reads the crosswalk side by bucket and shuffles
only the other side, into the same number of partitions.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import conform, empty_crosswalk
from .schemas import CROSSWALK_SCHEMA
from .sinks import _fs_and_path

# Buckets of the crosswalk; fixed for its life, as every folder must agree.
CROSSWALK_BUCKETS = 32


def write_bucketed_crosswalk(df: DataFrame, location: str, n_buckets: int = CROSSWALK_BUCKETS) -> None:
    """Write crosswalk rows to a new folder, by table and bucket.

    Rows are spread by the hash that also picks the bucket, so each bucket is
    written by one task, whatever table has most of the pairs.
    """
    name = f"_crosswalk_{uuid.uuid4().hex}"
    pairs = df.select("table_name", "old_id", "new_id").repartition(n_buckets, "old_id")
    writer = pairs.write.partitionBy("table_name").bucketBy(n_buckets, "old_id").sortBy("old_id")
    writer.option("path", location).mode("overwrite").format("parquet").saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE `{name}`")  # an external table: its files stay


def read_bucketed_crosswalk(spark: SparkSession, folders: list[str], n_buckets: int = CROSSWALK_BUCKETS) -> DataFrame:
    """The crosswalk made up of these folders; none is an empty one."""
    if not folders:
        return empty_crosswalk(spark)
    name = f"_crosswalk_{hashlib.sha256(repr((folders, n_buckets)).encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE `{name}` (old_id BIGINT, new_id BIGINT, run INT, table_name STRING) USING parquet "
            f"PARTITIONED BY (run, table_name) CLUSTERED BY (old_id) SORTED BY (old_id) INTO {n_buckets} BUCKETS "
            f"LOCATION '{folders[0]}'"
        )
        for run, folder in enumerate(folders):
            fs, path, _ = _fs_and_path(spark, folder)
            for status in fs.listStatus(path):
                table = status.getPath().getName().removeprefix("table_name=")
                if status.isDirectory() and table != status.getPath().getName():
                    spark.sql(f"ALTER TABLE `{name}` ADD PARTITION (run={run}, table_name='{table}') LOCATION '{status.getPath()}'")
    return conform(spark.table(name).drop("run"), CROSSWALK_SCHEMA).select(*[F.col(c) for c in CROSSWALK_SCHEMA.fieldNames()])
