"""Phrase collocation mining: each language's best-scored phrases, by best-first branch and bound.

A phrase ``w1..wm`` (2 to 5 words) that occurs ``a >= min_count`` times has the
score ``floor(1000 * a * n / (l * r))`` of its lowest-scoring cut into a first
part (``l`` occurrences) and a rest (``r``); ``n`` counts the language's words.
As ``a <= r`` and ``a <= l``, no phrase that begins or ends in a word of ``f``
occurrences scores above ``1000 * n / f``: the counts of one-word prefixes
bound all growth from them, rare words have the highest bounds.

The frontier is the words, grouped by their bound (``levels``).  A round takes
the best group that is left and grows all phrases that begin or end in one of
its words: pairs first, and from the pairs that are frequent the longer ones.
What it counts is all that phrases need whose first and last word have been
taken: their prefixes, their suffixes, and their extensions by one word, which
tell whether a longer phrase holds all their occurrences.  A language is
settled when its ``top``-th best surviving score, ties included, is above the
bound of its best word left; settled languages are not grown any more.

The corpus is held as written blocks of one language: the words of the block
and its texts as word numbers.  Counts travel as one row per block and phrase,
never per occurrence, so a phrase that stands everywhere moves once a block.
Pairs, the bulk of what is counted, travel as two word ids; only those that are
frequent get their text.

Edge cases: a null text is empty, a null language is ``und``; a phrase never
runs on into another piece or row; repeated rows count each; ties are broken by
occurrences, then by the phrase's bytes; an empty table, and a language without
a frequent phrase, give no rows.  Only language and text are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shipping import ship_package
from .staging import put, stage_area
from .text import LOWER_AZ

MIN_COUNT, TOP, MAX_WORDS = 100, 2000, 5
UNKNOWN_LANGUAGE = "und"
# Words whose bounds differ by less than this factor are taken in the same round.
LEVEL_FACTOR = 16
BLOCK_BYTES = 16 << 20
# Texts a task holds before it writes its blocks, whatever the number of languages.
HELD_BYTES = 48 << 20

# What separates pieces, and words inside a piece.
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_APART = _BREAK.copy()
_APART[list(SPACES)] = True

_BLOCK = "block long, lang string, n long, words array<string>, times array<long>, tokens binary"
_LEVELLED = "block long, lang string, words array<string>, ids array<long>, levels array<int>, tokens binary"
_PAIRS = "block long, at long, one long, two long, n long"
_GRAMS = "lang string, phrase string, size int, n long, low int, high int"


def _pack(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values, "<i4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(raw: bytes) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    data = pa.decompress(raw[8:], size, codec="zstd", asbytes=True) if size else b""
    return np.frombuffer(data, "<i4").astype(np.int64)


def tokenise(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of lower-cased text, and the text as word numbers, -1 between pieces."""
    data = LOWER_AZ[np.frombuffer(text, np.uint8)]
    inside = np.concatenate(([False], ~_APART[data], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    letters = np.ascontiguousarray(data[inside[1:-1]])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes()))
    coded = words.dictionary_encode()
    # Counted at the words only: a running count over the bytes would hold sixteen bytes for each.
    breaks = np.flatnonzero(_BREAK[data])
    apart = np.flatnonzero(np.searchsorted(breaks, starts[1:]) > np.searchsorted(breaks, ends[:-1])) + 1
    return coded.dictionary.cast(pa.string()), np.insert(coded.indices.to_numpy().astype(np.int64), apart, -1)


def word_blocks(df: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """``df(lang, text)`` as blocks of one language: its words, how often each occurs, and the texts as word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        bytes_of: dict[str, int] = {}
        total = 0

        def row(lang: str) -> pa.RecordBatch:
            words, tokens = tokenise(b"\n".join(held.pop(lang)))
            times = np.bincount(tokens[tokens >= 0], minlength=len(words))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (words, pa.array(times, pa.int64()))]
            arrays = [pa.array([number], pa.int64()), pa.array([lang]), pa.array([int(times.sum())], pa.int64()), *lists, pa.array([_pack(tokens)])]
            return pa.RecordBatch.from_arrays(arrays, names=["block", "lang", "n", "words", "times", "tokens"])

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                held.setdefault(lang, []).append(text or b"")
                more = len(text or b"") + 1
                bytes_of[lang] = bytes_of.get(lang, 0) + more
                total += more
                for each in list(held) if total >= HELD_BYTES else [lang] if bytes_of[lang] >= size else []:
                    total -= bytes_of.pop(each)
                    yield row(each)
                    number += 1
        for each in list(held):
            yield row(each)
            number += 1

    return df.mapInArrow(run, _BLOCK)


def word_places(blocks: DataFrame, min_count: int, level_factor: int = LEVEL_FACTOR) -> DataFrame:
    """``of, at, f, level, id, lang, phrase``: where the blocks list words of at least ``min_count`` occurrences.

    The level grows with ``f``.  Only a word's first row names it and its language; no join looks counts up, as
    one sort by word gives every row its word's count.  The ids are unique but differ from run to run: the
    table is to be written before they are used.
    """
    word = Window.partitionBy("lang", "phrase")
    each = blocks.select(F.col("block").alias("of"), "lang", F.posexplode(F.arrays_zip("words", "times")).alias("at", "x"))
    each = each.select("of", "at", "lang", F.col("x.words").alias("phrase"), F.col("x.times").alias("times"))
    counted = each.withColumn("f", F.sum("times").over(word)).where(F.col("f") >= min_count)
    numbered = counted.withColumn("row", F.monotonically_increasing_id()).withColumn("id", F.min("row").over(word))
    level = F.floor(F.log(F.col("f") / F.lit(min_count)) / F.log(F.lit(float(level_factor)))).cast("int")
    named = [F.when(F.col("row") == F.col("id"), F.col(c)).alias(c) for c in ("lang", "phrase")]
    return numbered.select("of", "at", "f", level.alias("level"), "id", *named)


def frequent_words(places: DataFrame) -> DataFrame:
    """``lang, phrase, f, level, id``: each word of ``word_places`` once."""
    return places.where(F.col("phrase").isNotNull()).select("lang", "phrase", "f", "level", "id")


def levelled_blocks(blocks: DataFrame, places: DataFrame) -> DataFrame:
    """The blocks with the id and level of every frequent word; the others are taken out and separate pieces."""
    known = places.select("of", "at", "level", "id")

    def run(block: pa.Table, levels: pa.Table) -> pa.Table:
        words = block.column("words")[0].values
        at, level, ids = (levels.column(c).to_numpy() for c in ("at", "level", "id"))
        order = np.argsort(at)
        at, level, ids = at[order], level[order], ids[order]
        place = np.full(len(words) + 1, -1, np.int64)  # the last entry stands for -1, a break
        place[at] = np.arange(len(at))
        tokens = place[_unpack(block.column("tokens")[0].as_py())]
        again = np.zeros(len(tokens), bool)
        again[1:] = (tokens[1:] < 0) & (tokens[:-1] < 0)
        kept = pa.array(words.take(pa.array(at, pa.int64())), pa.string())
        values = (kept, pa.array(ids, pa.int64()), pa.array(level, pa.int32()))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in values]
        arrays = [block.column("block"), block.column("lang"), *lists, pa.array([_pack(tokens[~again])])]
        return pa.Table.from_arrays(arrays, names=["block", "lang", "words", "ids", "levels", "tokens"])

    narrow = blocks.select("block", "lang", "words", "tokens")
    return narrow.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(run, _LEVELLED)


def _rows(block: dict, size: int, start: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """Grams of ``size`` words, each by one of its starts, and how often they occur."""
    index = [block["tokens"][start + k] for k in range(size)]
    words = [block["words"].take(pa.array(i, pa.int64())) for i in index]
    first, last = block["levels"][index[0]], block["levels"][index[-1]]
    arrays = [
        pa.array([block["lang"]] * len(start), pa.string()),
        pc.binary_join_element_wise(*words, " "),
        pa.array(np.full(len(start), size), pa.int32()),
        pa.array(times, pa.int64()),
        pa.array(np.minimum(first, last), pa.int32()),
        pa.array(np.maximum(first, last), pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _GRAMS.split(", ")])


def _opened(row: dict) -> dict:
    tokens = _unpack(row["tokens"].as_py())
    levels = row["levels"].values.to_numpy().astype(np.int64)
    return {
        "block": row["block"].as_py(),
        "lang": row["lang"].as_py(),
        "words": row["words"].values.cast(pa.string()),
        "ids": row["ids"].values.to_numpy(),
        "levels": levels,
        "tokens": tokens,
        # Level of the word at every place; one no word has where a piece ends.
        "level": np.concatenate((levels, [-1]))[tokens] if len(tokens) else tokens,
    }


def pairs_of_level(blocks: DataFrame, level: int) -> DataFrame:
    """``block, at, one, two, n``: pairs of words, the rarer of this level, and how often each block holds them.

    ``one`` and ``two`` are the words' ids, ``at`` their numbers in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = _opened({c: batch.column(c)[k] for c in batch.schema.names})
                tokens, ids = block["tokens"], block["ids"]
                starts = np.flatnonzero(np.minimum(block["level"][:-1], block["level"][1:]) == level)
                at, n = np.unique(tokens[starts] << 32 | tokens[starts + 1], return_counts=True)
                columns = (np.full(len(at), block["block"]), at, ids[at >> 32], ids[at & 0xFFFFFFFF], n)
                names = [f.split()[0] for f in _PAIRS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return blocks.mapInArrow(run, _PAIRS)


def frequent_pairs(pairs: DataFrame, words: DataFrame, min_count: int) -> DataFrame:
    """``one, two, lang, phrase, f, size, low, high, first, last`` of the pairs with ``min_count`` occurrences."""
    counted = pairs.groupBy("one", "two").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    one = words.select(F.col("id").alias("one"), "lang", F.col("phrase").alias("a"), F.col("level").alias("first"))
    two = words.select(F.col("id").alias("two"), F.col("phrase").alias("b"), F.col("level").alias("last"))
    return counted.join(one, "one").join(two, "two").select(
        "one", "two", "lang", F.concat_ws(" ", "a", "b").alias("phrase"), "f", F.lit(2).alias("size"),
        F.least("first", "last").alias("low"), F.greatest("first", "last").alias("high"), "first", "last",
    )


def longer_of_level(blocks: DataFrame, pairs: DataFrame, level: int, max_words: int) -> DataFrame:
    """Longer grams, the rarer end of this level, grown from the frequent pairs of each block.

    ``pairs(of, at)`` names every frequent pair that begins or ends in a word of the level.
    """

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        schema = pa.schema([(f.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[f.split()[1]]) for f in _GRAMS.split(", ")])
        if not len(known) or not len(block):  # the pairs of a settled language stay behind
            return schema.empty_table()
        open_ = _opened({c: block.column(c)[0] for c in block.column_names})
        tokens, rank = open_["tokens"], open_["level"]
        both = np.flatnonzero((tokens[:-1] >= 0) & (tokens[1:] >= 0))
        frequent = np.zeros(len(tokens), bool)
        frequent[both] = np.isin(tokens[both] << 32 | tokens[both + 1], known.column("at").to_numpy())
        after = np.concatenate((rank, [-1]))
        ends = np.concatenate((np.flatnonzero(tokens < 0), [len(tokens)]))
        wanted = []  # for each size which starts to count
        for size in range(3, max_words + 1):
            starts = np.union1d(
                np.flatnonzero(frequent & (rank == level)),  # grown to the right from a pair at their start
                np.flatnonzero(frequent[size - 2 :] & (after[size - 1 :] == level)),  # to the left from one at their end
            )
            starts = starts[starts + size <= ends[np.searchsorted(ends, starts)]]
            wanted.append(starts[np.minimum(rank[starts], rank[starts + size - 1]) == level])
        out = []
        # All starts grow word by word; each step numbers (gram so far, next word) exactly.
        alive = np.unique(np.concatenate(wanted))
        room = ends[np.searchsorted(ends, alive)] - alive
        key = tokens[alive]
        for size in range(2, max_words + 1):
            alive, room, key = alive[room >= size], room[room >= size], key[room >= size]
            key = np.unique(key * len(open_["words"]) + tokens[alive + size - 1], return_inverse=True)[1]
            if size >= 3 and len(wanted[size - 3]):
                starts = wanted[size - 3]
                gram = key[np.searchsorted(alive, starts)]
                times = np.bincount(gram)
                where = np.zeros(len(times), np.int64)
                where[gram] = starts
                seen = times > 0
                out.append(_rows(open_, size, where[seen], times[seen]))
        return pa.Table.from_batches(out, schema) if out else schema.empty_table()

    return blocks.groupBy("block").cogroup(pairs.groupBy("of")).applyInArrow(run, _GRAMS)


def _summed(grams: DataFrame, min_count: int) -> DataFrame:
    counted = grams.groupBy("lang", "phrase").agg(
        F.sum("n").alias("f"), F.max("size").alias("size"), F.max("low").alias("low"), F.max("high").alias("high")
    )
    return counted.where(F.col("f") >= min_count)


def _without(end: str) -> Column:
    """The phrase without its first or its last word."""
    if end == "last":
        return F.expr("substring_index(phrase, ' ', size - 1)")
    return F.expr("substring_index(phrase, ' ', 1 - size)")


def surviving(candidates: DataFrame, counted: DataFrame) -> DataFrame:
    """Candidates of whose occurrences no longer phrase holds all."""
    longer = counted.where(F.col("size") >= 3)
    held = longer.select("lang", _without("last").alias("phrase"), "f").unionByName(
        longer.select("lang", _without("first").alias("phrase"), "f")
    )
    most = held.groupBy("lang", "phrase").agg(F.max("f").alias("held"))
    return candidates.join(most, ["lang", "phrase"], "left").where(F.coalesce("held", F.lit(0)) < F.col("f")).drop("held")


def scored(candidates: DataFrame, counted: DataFrame, words: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` by the lowest-scoring cut (of equal ones the first)."""
    parts = counted.select("lang", "phrase", "f").unionByName(words.select("lang", "phrase", "f"))
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("front"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    left = parts.select("lang", F.col("phrase").alias("front"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    known = cuts.join(left, ["lang", "front"]).join(right, ["lang", "rest"]).join(sizes, "lang")
    wide = "CAST({} AS DECIMAL(19,0))".format
    rated = known.withColumn("score", F.expr(f"(1000BD * ({wide('a')} * {wide('n')})) div ({wide('l')} * {wide('r')})"))
    lowest = rated.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x"))
    return lowest.select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.col("phrase"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine_phrases(
    df: DataFrame,
    lang: str = "lang",
    text: str = "text",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    max_words: int = MAX_WORDS,
    block_bytes: int = BLOCK_BYTES,
    level_factor: int = LEVEL_FACTOR,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` surviving phrases."""
    spark = df.sparkSession
    ship_package(spark)
    area = stage_area(spark, "phrases")
    source = df.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), F.col(f"`{text}`").alias("text"))
    raw = put(area, word_blocks(source, block_bytes), "raw")
    places = put(area, word_places(raw, min_count, level_factor), "places")
    words = put(area, frequent_words(places), "words")
    sizes = put(area, raw.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    blocks = put(area, levelled_blocks(raw, places), "blocks")
    area.drop("raw", "places")
    levels = [r["level"] for r in words.select("level").distinct().orderBy("level").collect()]
    none = spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long")
    results, counted, known, open_ = none, None, None, sizes
    for level in levels:
        growing = blocks.join(open_.select("lang"), "lang", "left_semi").select(*blocks.columns)
        pairs = put(area, pairs_of_level(growing, level), f"pairs-{level}")
        kept = put(area, frequent_pairs(pairs, words, min_count), f"kept-{level}")
        placed = pairs.join(kept.select("one", "two", "first", "last"), ["one", "two"])
        here = put(area, placed.select(F.col("block").alias("of"), "at", "first", "last"), f"here-{level}")
        area.drop(f"pairs-{level}")
        known = here if known is None else known.unionByName(here)
        mine = known.where((F.col("first") == level) | (F.col("last") == level)).select("of", "at")
        longer = put(area, _summed(longer_of_level(growing, mine, level, max_words), min_count), f"longer-{level}")
        found = kept.select(*longer.columns).unionByName(longer)
        counted = found if counted is None else counted.unionByName(found)
        ready = counted.where(F.col("high") == level).join(open_.select("lang"), "lang", "left_semi")
        new = put(area, scored(surviving(ready, counted), counted, words, sizes), f"scored-{level}")
        results = results.unionByName(new)
        open_ = put(area, unsettled(results, words, sizes, open_, level, top), f"open-{level}")
        if open_.isEmpty():
            break
    out = _ranked(results, top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def unsettled(results: DataFrame, words: DataFrame, sizes: DataFrame, open_: DataFrame, level: int, top: int) -> DataFrame:
    """Languages that a word left can still add to: its bound reaches the ``top``-th best score so far."""
    left = words.where(F.col("level") > level).groupBy("lang").agg(F.min("f").alias("f"))
    bound = F.expr("(CAST(1000 AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))) div CAST(f AS DECIMAL(19,0))")
    last = _ranked(results, top).where(F.col("rank") == top).select("lang", "score")
    waiting = open_.select("lang").join(left, "lang").join(sizes, "lang").join(last, "lang", "left")
    return waiting.where(F.col("score").isNull() | (bound >= F.col("score"))).select("lang")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: the 2000 best phrases of every language."""
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_SEP = r"[.,;:!?\x0A-\x0D]"

OP13_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT doc, lang, unnest(string_split_regex(text, '{_SEP}')) AS piece FROM texts
), numbered AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), counted AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, m, count(*) AS f
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM numbered), range(1, 6) AS s(m)
  WHERE i + m - 1 <= len(ws)
  GROUP BY ALL
), sizes AS (SELECT lang, sum(f) AS n FROM counted WHERE m = 1 GROUP BY lang),
grams AS (SELECT * FROM counted WHERE f >= 100),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, array_to_string(string_split(phrase, ' ')[: m - 1], ' ') AS phrase, f FROM grams WHERE m > 1
    UNION ALL
    SELECT lang, array_to_string(string_split(phrase, ' ')[2 :], ' ') AS phrase, f FROM grams WHERE m > 1
  ) GROUP BY ALL
), candidates AS (
  SELECT g.* FROM grams g LEFT JOIN longer h ON g.lang = h.lang AND g.phrase = h.phrase
  WHERE g.m >= 2 AND coalesce(h.f, 0) < g.f
), cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[: k], ' ') AS front,
         array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS rest
  FROM candidates, range(1, 5) AS c(k) WHERE k < m
), scores AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.front
       JOIN grams y ON y.lang = c.lang AND y.phrase = c.rest JOIN sizes s ON s.lang = c.lang
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER w AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM best WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000
"""
