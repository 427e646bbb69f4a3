"""CVE mentions kept current as changelog files arrive (the log side of W4, streaming).

A file-source stream over the changelog folder extracts CVE identifiers
(built-in ``regexp_extract_all`` + ``explode``, no Python), joins them with
the CVE name table (a stream-static join) and appends ``(pkg_vrs_id, vulnerability_id, chg_id)`` rows to a
parquet sink.  The file sink's commit log plus the source checkpoint make the
output exactly-once across restarts and lost executors.  The whole pipeline
runs in the JVM: no Python callback is involved.

``log_evidence_from_feed`` turns the accumulated rows into the per
(version, CVE) log evidence the fix-status job merges; it equals the batch
``evidence.log_evidence`` over the same changelog rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.cve import cve_tokens
from ..operators.evidence import cve_ids_by_name
from ..session import ensure_checkpoint_dir
from ..sources.schemas import TARGET_SCHEMAS

FEED_SCHEMA = "pkg_vrs_id long, vulnerability_id long, chg_id long"


def start_mention_feed(
    spark: SparkSession,
    changelog_dir: str,
    out_dir: str,
    vulnerabilities: DataFrame,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the feed; ``available_now`` processes the files present and stops."""
    if checkpoint_location is None:
        # One folder per output, so that two feeds never share a commit log.
        name = hashlib.sha256(out_dir.encode()).hexdigest()[:16]
        checkpoint_location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cve-mention-feed-{name}"
    reader = spark.readStream.schema(TARGET_SCHEMAS["changelog"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    changes = reader.parquet(changelog_dir)
    names = cve_ids_by_name(vulnerabilities).withColumnRenamed("name", "cve")
    mentions = changes.select(
        F.col("id").alias("chg_id"), "pkg_vrs_id", F.explode(cve_tokens("log_desc")).alias("cve")
    ).join(names, "cve")
    writer = (
        mentions.select("pkg_vrs_id", "vulnerability_id", "chg_id")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.queryName("catalink_cve_mention_feed").start()


def log_evidence_from_feed(feed: DataFrame) -> DataFrame:
    """First changelog id per (version, CVE) over everything the feed wrote."""
    return feed.groupBy("pkg_vrs_id", "vulnerability_id").agg(F.min("chg_id").alias("changelog_string_number"))
