"""A Bloom filter of one side's keys ahead of an exact join.

An anti join of a small delta against a huge table shuffles the whole table,
though only keys that the delta holds can matter.  The delta's keys make a
filter of fixed size, and the table's rows that it rules out stay where they
were read; the exact join follows on what is left.  The filter never rules out
a key it was made from, so results do not depend on it, and a delta too large
for it only makes it pass more rows.

The filter is blocked: a key sets two bits of one 64-bit word.  Words are
``bit_or`` aggregates, combined before the shuffle, so a key held by a third of
all rows collapses map-side; at most ``words`` rows of two longs are broadcast,
whatever the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^18 words of 64 bits: 4 MB of rows broadcast; about one row in twenty passes by chance at 2 million keys.
WORDS = 1 << 18


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words))


def _bits(keys: Sequence[str]) -> Column:
    """Two of 64 bits, from a hash that does not depend on the word's."""
    h = F.hash(*keys, F.lit("bits"))
    one, two = F.pmod(h, F.lit(64)), F.pmod(F.shiftrightunsigned(h, 8), F.lit(64))
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at)
    return bit(one).bitwiseOR(bit(two))


def key_filter(df: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """``_word, _mask``: the Bloom filter of ``df``'s keys, at most ``words`` rows."""
    hashed = df.select(_word(keys, words).alias("_word"), _bits(keys).alias("_bits"))
    return hashed.groupBy("_word").agg(F.bit_or("_bits").alias("_mask"))


def may_hold(df: DataFrame, keys: Sequence[str], key_words: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``df`` whose key the filter does not rule out; no shuffle of ``df``."""
    tested = df.withColumn("_at", _word(keys, words)).withColumn("_bits", _bits(keys))
    found = (F.col("_at") == F.col("_word")) & (F.col("_mask").bitwiseAND(F.col("_bits")) == F.col("_bits"))
    return tested.join(F.broadcast(key_words), found, "left_semi").select(*df.columns)


def anti_join_filtered(delta: DataFrame, existing: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """Rows of ``delta`` whose key is not in ``existing``, whose other rows are filtered out before the join.

    As in any equi-join a NULL key equals none, so such rows of ``delta`` stay;
    an empty ``delta`` gives no rows, an empty ``existing`` all.  ``delta`` is
    read twice (filter, join): it should be a written table.
    """
    near = may_hold(existing.select(*keys), keys, key_filter(delta, keys, words), words)
    return delta.join(near, list(keys), "left_anti")
