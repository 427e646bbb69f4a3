"""Quality rules with thresholds that adapt to language and source.

Every document gets counts over its whole text.  Two fixed base rules judge
it first (too few words, too much repetition); the others are judged against
mergeable KLL quantile sketches, one per rule and ``(lang, source)``, of the
documents that pass the base rules.  A document is rejected when a value lies
beyond the far-out fence ``quartile -+ (spread * interquartile range + room)``:

* The room of a share (symbols, repeated lines, repeated words) comes from the
  far tail of the language, merged from the sketches of all its sources:
  ``TAIL_REACH`` times its ``TAIL`` quantile, at most the rule's slack and at
  least half of it.  Where more than a quarter of the documents have the value
  0, both quartiles can be 0, and the room alone is the fence.
* A source's own fence never lies beyond that of its language, so a source that
  is full of junk cannot switch its rule off.  A language whose fence leaves the
  range of a share (100 %) takes that of the corpus, and where this leaves it as
  well, the room alone.

A group with fewer than ``min_docs`` such documents takes the fence of its
language, and a small language that of the whole corpus.

Edge cases: a null or empty text has no words and fails the base rules; a
null language or source is a group of its own; repeated rows are judged each;
an empty table gives an empty result.  The thresholds are joined back on the
narrow table of counts, and ``filter_documents`` works on a row tag of its
own, so that repeated ids or clashing column names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import ship_package
from .staging import put, stage_area
from .text import Rolling, blocks, combine, mix, word_hashes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
MIN_GROUP_DOCS = 200
SPREAD = 6.0
# The far tail that gives a share's room, and how far beyond it the room reaches.
TAIL = 0.99
TAIL_REACH = 1.5
# Sketch size: rank error about 0.3 %; a group's sketch has a few kilobytes whatever its rows.
KLL_K = 800

# rule: (value from the counts, which fences hold, slack in the value's unit)
RULES: dict[str, tuple[str, str, float]] = {
    "symbols_per_char": ("n_symbols / word_chars", "high", 0.05),
    "dup_line_share": ("n_dup_lines / n_lines", "high", 0.40),
    "repeat_share": ("n_repeat_words / n_words", "high", 0.25),
    "mean_word_chars": ("word_chars / n_words", "both", 0.75),
}

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_LEAD = (np.arange(256) & 0xC0) != 0x80

COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def _seen_before(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice or more; is it one after the first."""
    if len(keys) == 0:
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.concatenate(([False], same))
    many = later | np.concatenate((same, [False]))
    out_many, out_later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    out_many[order], out_later[order] = many, later
    return out_many, out_later


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        hashes, starts, ends, first = word_hashes(block)
        data, off, docs = block.data, block.off, block.rows
        per = lambda marks: np.diff(np.concatenate(([0], np.cumsum(marks)))[off])
        n_words = np.diff(first)
        doc_of = np.repeat(np.arange(docs), n_words)
        # code points inside words: lead bytes of the words' ranges
        lead = np.concatenate(([0], np.cumsum(_IS_LEAD[data])))
        chars = np.bincount(doc_of, weights=lead[ends] - lead[starts], minlength=docs).astype(np.int64)
        # lines: cut at \n and at document ends
        breaks = np.flatnonzero(data == 0x0A)
        begin = np.unique(np.concatenate((off[:-1], breaks + 1)))
        begin = begin[begin < len(data)]
        owner = np.searchsorted(off, begin, side="right") - 1
        stop = np.append(begin[1:], len(data))
        stop = np.minimum(stop, off[owner + 1])
        stop -= (data[stop - 1] == 0x0A) & (stop > begin) if len(begin) else 0
        has_word = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
        begin, stop, owner = begin[has_word], stop[has_word], owner[has_word]
        line = Rolling(mix(data.astype(np.uint64) + np.uint64(1))).ranges(begin, stop)
        _, later = _seen_before(combine(line, owner.astype(np.uint64)))
        n_lines = np.bincount(owner, minlength=docs)
        dup_lines = np.bincount(owner, weights=later, minlength=docs).astype(np.int64)
        # three-word windows found twice or more inside one document
        windows = Rolling(hashes).windows(3)
        inside = doc_of[: len(windows)] == doc_of[2:] if len(windows) else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        many, _ = _seen_before(combine(windows[at], doc_of[at].astype(np.uint64)))
        repeated = np.zeros(len(hashes), bool)
        for k in range(3):
            repeated[at[many] + k] = True
        repeats = np.bincount(doc_of, weights=repeated, minlength=docs).astype(np.int64)
        values = [n_words, chars, per(_IS_SYMBOL[data]), n_lines, dup_lines, repeats]
        names = [c.split()[0] for c in COUNTS.split(", ")]
        keys = [f.name for f in block.batch.schema if f.name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(block.arrow(k) for k in keys), *(pa.array(np.asarray(v, np.int64)) for v in values)], names=[*keys, *names]
        )


def document_counts(docs: DataFrame, keep: str | T.StructType) -> DataFrame:
    """The counts of every whole text, with the key columns ``keep`` (``name type, ...``, or their schema)."""
    ship_package(docs.sparkSession)
    keep = T.StructType.fromDDL(keep) if isinstance(keep, str) else keep
    schema = T.StructType([*keep.fields, *T.StructType.fromDDL(COUNTS).fields])
    return docs.select(*keep.fieldNames(), "text").mapInArrow(_counts, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _value(rule: str) -> Column:
    top, bottom = RULES[rule][0].split(" / ")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0)).cast("double")


def _quantile(sketch: Column, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(q))


def _quantiles(sketches: DataFrame, tag: str) -> DataFrame:
    """The key columns, and per rule the quartiles and the far tail, named by ``tag``."""
    out = [c for c in ("lang", "source") if c in sketches.columns] + [F.col("n").alias(f"n_{tag}")]
    for rule in RULES:
        sketch = F.when(F.col("n") > 0, F.col(rule))  # without a document that passes there is no fence
        for name, q in (("q1", 0.25), ("q3", 0.75), ("tail", TAIL)):
            out.append(_quantile(sketch, q).alias(f"{rule}_{name}_{tag}"))
    return sketches.select(*out)


def _room(rule: str, tag: str) -> Column:
    """What a fence grants beyond the spread: for a share, from the far tail, inside half the slack and the slack."""
    _, side, slack = RULES[rule]
    if side == "both":
        return F.lit(slack)
    return F.least(F.lit(slack), F.greatest(F.lit(slack / 2), F.col(f"{rule}_tail_{tag}") * TAIL_REACH))


def thresholds(counts: DataFrame, min_docs: int = MIN_GROUP_DOCS) -> DataFrame:
    """``lang, source, <rule>_low, <rule>_high``: the fences of every group that occurs in ``counts``.

    One pass builds a sketch per group and rule (partial aggregation, so a
    source with a third of the rows sends one sketch per task); languages and
    the corpus merge those sketches, they never read the documents again.
    """
    passed = counts.filter(~base_failed())
    built = passed.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.kll_sketch_agg_double(_value(rule), F.lit(KLL_K)).alias(rule) for rule in RULES),
    )
    area = stage_area(counts.sparkSession, "quality")
    sketches = put(area, built, "sketches")
    merge = [F.kll_merge_agg_double(rule).alias(rule) for rule in RULES]
    by_lang = put(area, sketches.groupBy("lang").agg(F.sum("n").alias("n"), *merge), "languages")
    corpus = by_lang.agg(F.sum("n").alias("n"), *merge)

    groups = counts.select("lang", "source").distinct()
    own, lang, everything = _quantiles(sketches, "own"), _quantiles(by_lang, "lang"), _quantiles(corpus, "all")
    joined = (
        groups.alias("g")
        .join(own.alias("o"), F.expr("g.lang <=> o.lang AND g.source <=> o.source"), "left")
        .join(lang.alias("l"), F.expr("g.lang <=> l.lang"), "left")
        .crossJoin(F.broadcast(everything))  # one row: the corpus
    )
    large = lambda tag: F.col(f"n_{tag}") >= min_docs
    out: list[Column] = [F.col("g.lang").alias("lang"), F.col("g.source").alias("source")]
    for rule, (_, side, slack) in RULES.items():
        room = F.when(large("lang"), _room(rule, "lang")).otherwise(_room(rule, "all"))
        reach = lambda tag: (F.col(f"{rule}_q3_{tag}") - F.col(f"{rule}_q1_{tag}")) * SPREAD + room  # noqa: B023, E731
        high = {tag: F.col(f"{rule}_q3_{tag}") + reach(tag) for tag in ("own", "lang", "all")}
        low = {tag: F.col(f"{rule}_q1_{tag}") - reach(tag) for tag in ("own", "lang", "all")}
        if side == "both":
            top = F.when(large("lang"), high["lang"]).otherwise(high["all"])
            bottom = F.when(large("lang"), low["lang"]).otherwise(low["all"])
            bottom = F.when(large("own"), F.greatest(low["own"], bottom)).otherwise(bottom)
        else:  # a share: no fence beyond 100 %
            top = F.when(large("lang") & (high["lang"] < 1), high["lang"]).when(high["all"] < 1, high["all"]).otherwise(room)
            bottom = F.lit(None).cast("double")
        top = F.when(large("own"), F.least(high["own"], top)).otherwise(top)
        out += [bottom.alias(f"{rule}_low"), top.alias(f"{rule}_high")]
    return put(area, joined.select(*out), "thresholds")


def judge(counts: DataFrame, fences: DataFrame) -> DataFrame:
    """``counts`` with ``base_failed`` and ``kept``.

    The table of fences is small in practice; Spark decides by its written
    size whether to broadcast it, and beyond that splits a hot group's join
    partition (both sides are plain shuffles).
    """
    f = fences.withColumnsRenamed({"lang": "fence_lang", "source": "fence_source"})
    on = F.col("lang").eqNullSafe(F.col("fence_lang")) & F.col("source").eqNullSafe(F.col("fence_source"))
    beyond = F.lit(False)
    for rule in RULES:
        value = _value(rule)
        beyond = beyond | F.coalesce(value > F.col(f"{rule}_high"), F.lit(False))
        beyond = beyond | F.coalesce(value < F.col(f"{rule}_low"), F.lit(False))
    return (
        counts.join(f, on, "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~beyond)
        .select(*counts.columns, "base_failed", "kept")
    )


def quality_rules(docs: DataFrame, key: str = "doc_id long") -> DataFrame:
    """Counts and verdict of every row of ``docs(key, text, lang, source)``."""
    area = stage_area(docs.sparkSession, "quality-counts")
    counts = put(area, document_counts(docs, f"{key}, lang string, source string"), "counts")
    return judge(counts, thresholds(counts))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged.

    The counts are taken once for the fences and once more beside the rows
    they judge: no text is shuffled, and rows need no unique id.
    """
    area = stage_area(docs.sparkSession, "quality-filter")
    counts = put(area, document_counts(docs, "lang string, source string"), "counts")
    fences = thresholds(counts)
    tagged = docs.select(F.struct("*").alias("row"), "lang", "source", "text")
    kept = T.StructType([tagged.schema[c] for c in ("row", "lang", "source")])
    judged = judge(document_counts(tagged, kept), fences)
    return judged.filter("kept").select("row.*")


def op6_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: counts of the whole text, base rules and adaptive verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "source"
    )
