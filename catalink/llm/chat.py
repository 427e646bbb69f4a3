"""Chat formatting with collapse of cumulative snapshots (DataFrame and SQL functions only).

A chat log often holds the same conversation several times, each time with
more turns.  A rolling hash over the turns gives every turn-prefix of every
conversation a key.  A conversation whose whole key is a proper-prefix key of
another is a snapshot of it and goes; of equal conversations the smallest
``conv_id`` stays.  The rest are rendered, one text each.

Edge cases: turns are ordered by turn number (null first), then role, then
digest; exactly repeated rows of a conversation count once; a null role or
text differs from an empty one in the hash and renders as nothing; of rows
with a null ``conv_id`` every distinct turn (role and text) is a conversation of
its own, so that a log that lost its ids is never gathered in one place; an
empty table gives an empty result.
Columns other than ``conv_id, turn, role, text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import put, stage_area

TURN_OPEN, TURN_CLOSE = "<|im_start|>", "<|im_end|>\n"


def _tagged(value: str) -> Column:
    """A null and an empty string must not hash alike."""
    return F.when(F.col(value).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(value)))


def _digest() -> Column:
    role = _tagged("role")
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, _tagged("text")).cast("binary"))


def _term(salt: str) -> Column:
    """A turn's share of the rolling hash: depends on its place, role and text."""
    return F.xxhash64("pos", "digest", F.lit(salt)).cast("decimal(20,0)")


def prefix_keys(turns: DataFrame) -> DataFrame:
    """``conv_id, lone, pos, key_a, key_b, last``: the key of the first ``pos`` turns, for every ``pos``.

    ``lone`` is the digest of a turn without a ``conv_id``, else null.  The keys are running sums over place-dependent turn hashes (two of 64
    bits), a window that streams over a conversation of any length.  Only the
    turns' digests are shuffled, not their texts.
    """
    narrow = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", "role", _digest().alias("digest"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "digest")
    this, before = F.struct("turn", "role", "digest"), F.lag(F.struct("turn", "role", "digest")).over(order)
    once = narrow.withColumn("again", before.isNotNull() & this.eqNullSafe(before)).filter(~F.col("again"))
    placed = once.withColumn("pos", F.row_number().over(order)).withColumn("last", F.lead("pos").over(order).isNull())
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = placed.select(
        "conv_id",
        F.lit(None).cast("string").alias("lone"),
        "pos",
        F.sum(_term("a")).over(running).alias("key_a"),
        F.sum(_term("b")).over(running).alias("key_b"),
        "last",
    )
    single = turns.filter("conv_id IS NULL").select("conv_id", _digest().alias("digest")).distinct()
    single = single.withColumn("pos", F.lit(1)).select(
        "conv_id",
        F.col("digest").alias("lone"),
        "pos",
        _term("a").cast("decimal(30,0)").alias("key_a"),
        _term("b").cast("decimal(30,0)").alias("key_b"),
        F.lit(True).alias("last"),
    )
    return chained.union(single)


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, lone, n_turns`` of the conversations that are no proper prefix of another, equal ones once."""
    area = stage_area(turns.sparkSession, "chat")
    keys = put(area, prefix_keys(turns), "prefix-keys")
    # Pre-aggregated: a conversation or a first turn that a third of the log shares becomes one row per task.
    whole = keys.filter("last").groupBy("key_a", "key_b").agg(
        F.min_by("conv_id", F.struct(F.col("conv_id").isNull(), "conv_id")).alias("conv_id"),
        # Only turns without a conv_id name their digest, and equal ones the same.
        F.max("lone").alias("lone"),
        F.first("pos").alias("n_turns"),
    )
    proper = keys.filter("not last").select("key_a", "key_b").distinct()
    return whole.join(proper, ["key_a", "key_b"], "left_anti").select("conv_id", "lone", "n_turns")


def _rendered(role: Column, text: Column) -> Column:
    none = F.lit("")
    return F.concat(F.lit(TURN_OPEN), F.coalesce(role, none), F.lit("\n"), F.coalesce(text, none), F.lit(TURN_CLOSE))


def render_conversations(turns: DataFrame, chosen: DataFrame) -> DataFrame:
    """``conv_id, n_turns, text``: the chosen conversations in the turn template."""
    named = turns.select("conv_id", "turn", "role", "text", _digest().alias("digest"))
    rows = (
        named.join(chosen.filter("conv_id IS NOT NULL").select("conv_id", "n_turns"), "conv_id")
        .groupBy("conv_id", "n_turns")
        .agg(F.array_sort(F.collect_set(F.struct("turn", "role", "digest", "text"))).alias("ts"))
    )
    # Struct order puts nulls first and compares turn, role, digest as the window does.
    joined = F.array_join(F.transform("ts", lambda t: _rendered(t["role"], t["text"])), "")
    several = rows.select("conv_id", "n_turns", joined.alias("text"))

    # Turns without a conv_id: one of equal ones, combined map-side, then looked up by digest.
    once = named.filter("conv_id IS NULL").groupBy("digest").agg(F.min(F.struct("role", "text")).alias("t"))
    picked = chosen.filter("conv_id IS NULL").select(F.col("lone").alias("digest"), "conv_id", "n_turns")
    single = picked.join(once, "digest").select("conv_id", "n_turns", _rendered(F.col("t.role"), F.col("t.text")).alias("text"))
    return several.union(single)


def format_chats(turns: DataFrame) -> DataFrame:
    """Maximal conversations, rendered."""
    return render_conversations(turns, maximal_conversations(turns))


def op10_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations: collapse of snapshots, then one rendered text per maximal conversation."""
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP10_SQL = f"""
WITH turns AS (
  SELECT DISTINCT conv_id, CASE WHEN conv_id IS NOT NULL THEN turn END AS turn, role, text,
         CASE WHEN role IS NULL THEN 'n' ELSE 'v' || role END AS tagged_role,
         CASE WHEN text IS NULL THEN 'n' ELSE 'v' || text END AS tagged_text
  FROM conversations),
digests AS (
  SELECT *, md5(length(tagged_role)::VARCHAR || ':' || tagged_role || tagged_text) AS digest,
         CASE WHEN conv_id IS NULL THEN digest END AS lone FROM turns),
prefixes AS (
  SELECT conv_id, string_agg(digest, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, digest) OVER w AS chain,
         row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id, lone) AS n
  FROM digests WINDOW w AS (PARTITION BY conv_id, lone ORDER BY turn NULLS FIRST, role NULLS FIRST, digest
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS (SELECT min(conv_id) AS conv_id, chain, any_value(n) AS n_turns FROM prefixes WHERE pos = n GROUP BY chain),
kept AS (SELECT conv_id, n_turns, CASE WHEN conv_id IS NULL THEN chain END AS lone FROM whole
         WHERE chain NOT IN (SELECT chain FROM prefixes WHERE pos < n))
SELECT k.conv_id, k.n_turns::INTEGER AS n_turns,
       string_agg('{TURN_OPEN}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
                  ORDER BY turn NULLS FIRST, role NULLS FIRST, digest) AS text
FROM kept k JOIN digests d ON k.conv_id IS NOT DISTINCT FROM d.conv_id AND k.lone IS NOT DISTINCT FROM d.lone
GROUP BY k.conv_id, k.lone, k.n_turns
"""
