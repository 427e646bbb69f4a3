"""The streaming mention feed gives the same log evidence as the batch operator."""

from pyspark.sql import functions as F

from catalink.operators import evidence as ev
from catalink.sources.catalog import conform
from catalink.sources.fixtures import fixture_catalogue
from catalink.sources.schemas import TARGET_SCHEMAS
from catalink.streaming.fix_status_feed import log_evidence_from_feed, start_mention_feed

SF = "/root/testdata/sf0.001"


def test_feed_matches_batch_log_evidence(spark, tmp_path):
    fx = fixture_catalogue(spark, SF)
    changelog = conform(
        fx.sources.changes.select("id", F.col("pkg_vsn_ref").alias("pkg_vrs_id"), F.col("special").alias("log_desc")),
        TARGET_SCHEMAS["changelog"],
    )
    cut = changelog.agg(F.percentile_approx("id", 0.5)).first()[0]
    feed_in = str(tmp_path / "changelog")
    changelog.where(F.col("id") <= cut).coalesce(1).write.mode("append").parquet(feed_in)
    changelog.where(F.col("id") > cut).coalesce(1).write.mode("append").parquet(feed_in)

    out = str(tmp_path / "mentions")
    query = start_mention_feed(
        spark, feed_in, out, fx.sources.vulnerabilities,
        checkpoint_location=str(tmp_path / "ckpt"), max_files_per_trigger=1,
    )
    try:
        query.awaitTermination(180)
    finally:
        query.stop()
    assert query.exception() is None
    assert len(query.recentProgress) >= 2  # two micro-batches, one file each

    got = sorted(map(tuple, log_evidence_from_feed(spark.read.parquet(out)).collect()))
    want = sorted(map(tuple, ev.log_evidence(ev.change_mentions(changelog), ev.cve_ids_by_name(fx.sources.vulnerabilities)).collect()))
    assert got == want and len(got) > 0
