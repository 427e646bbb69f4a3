"""Sharding by jump consistent hashing (DataFrame and SQL functions only).

The shard of a row is a function of its key and of the number of shards; no
ring table is kept.  With one shard more, a row either stays or moves to the
new shard, and about ``1 / (n + 1)`` of the rows move.

Edge cases: a null key hashes as key 0; a null text counts ``overhead`` bytes
and has the checksum of the empty string; repeated rows stay and get slots of
their own; an empty table gives an empty result.  The result holds the key and
the columns computed here only, so other columns of the input cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the published algorithm: multiplier of its 64-bit generator, and 2^64.
MULTIPLIER = 2862933555777941757
TWO64 = 1 << 64

# Slots are numbered inside so many buckets of a shard: no task sorts a whole shard.
SLOT_BUCKETS = 1024


def unsigned_key(key: str) -> str:
    """SQL: a long as unsigned 64-bit decimal; null is 0."""
    return (
        f"CAST(CASE WHEN {key} < 0 THEN CAST({key} AS DECIMAL(20,0)) + {TWO64}BD "
        f"ELSE CAST(coalesce({key}, 0) AS DECIMAL(20,0)) END AS DECIMAL(20,0))"
    )


def next_state(state: str) -> str:
    """SQL: one step of the generator, state * multiplier + 1 modulo 2^64, in exact decimals."""
    return f"CAST(({state} * {MULTIPLIER}BD + 1BD) % {TWO64}BD AS DECIMAL(20,0))"


def jump_shards(key: str, shards: int) -> str:
    """SQL struct ``(shard, grown)``: the shard among ``shards`` and among ``shards + 1``.

    A key's chain of jumps does not depend on the number of shards; its shard
    is the last jump below that number.  Every jump goes at least one shard
    on, hence ``shards + 1`` steps reach the end for any key; a row that is
    past it skips the rest.
    """
    drawn = "CAST(k div 8589934592BD AS DOUBLE)"
    return f"""aggregate(
        sequence(0, {shards}),
        named_struct('k', {unsigned_key(key)}, 'j', 0L, 'shard', 0, 'grown', 0),
        (s, step) -> CASE WHEN s.j > {shards} THEN s ELSE transform(array({next_state('s.k')}), k -> named_struct(
            'k', k,
            'j', CAST(floor((s.j + 1) * (2147483648D / ({drawn} + 1D))) AS BIGINT),
            'shard', CASE WHEN s.j < {shards} THEN CAST(s.j AS INT) ELSE s.shard END,
            'grown', CAST(s.j AS INT)))[0] END,
        s -> named_struct('shard', s.shard, 'grown', s.grown))"""


def shard_rows(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 16
) -> DataFrame:
    """Shard and slot of every row: ``key, size, text_crc32, law, shard, slot, grown_shard``.

    Slots count from 0 without gaps inside a shard.  Rows are ranked inside
    ``(shard, bucket)``, where the bucket is drawn from the key's first
    generator state and the text's checksum; the buckets' offsets come from
    their counts, a table of at most ``shards * SLOT_BUCKETS`` rows whatever
    the input, which is why it may be broadcast.
    """
    rows = docs.select(
        F.col(key).cast("long").alias(key),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    quoted = f"`{key}`"
    placed = rows.select(
        "*",
        F.expr(jump_shards(quoted, shards)).alias("at"),
        F.expr(
            f"CAST(({next_state(unsigned_key(quoted))} div 8589934592BD) ^ text_crc32 AS BIGINT) % {SLOT_BUCKETS}"
        ).cast("int").alias("bucket"),
    ).select(key, "size", "text_crc32", F.col("at.shard").alias("shard"), F.col("at.grown").alias("grown_shard"), "bucket")

    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    rank = Window.partitionBy("shard", "bucket").orderBy(key, "text_crc32", "size")
    ranked = placed.withColumn("rank", F.row_number().over(rank))
    return ranked.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        key,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"),
        "grown_shard",
    )


def op7_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 by jump consistent hashing of ``doc_id``."""
    return shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), 40)
