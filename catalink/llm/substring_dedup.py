"""Substring dedup: repeated windows of words, merged into maximal removal intervals.

Karp-Rabin hashes of every window of ``length`` consecutive words are rolled
over the text in the tasks; Spark counts them (first by runs of windows, see
``windows``, then one by one where a run is shared in part).  A word goes if a
window that covers it also starts in a document with a smaller id; windows are
judged on the input.

Edge cases: a null or empty text has no words; texts shorter than a window
keep all words; of documents with equal windows the smallest id keeps them,
a null id being the smallest; rows that repeat an id do not remove from one
another; an empty table gives an empty result; other columns ride along packed
in ``row``, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import Rolling
from .windows import Hashes, Scheme, cut_repeats, removed_symbols


def karp_rabin(sym: np.ndarray, s: Scheme) -> Hashes:
    rolling = Rolling(sym)
    return rolling.windows(s.gram), rolling.windows(s.core), rolling.windows(s.inner), rolling.windows(s.length)


def word_scheme(length: int) -> Scheme:
    spread = 1
    while spread * 2 <= max(1, length * 2 // 3):
        spread *= 2
    return Scheme(length=length, spread=spread, gram=min(4, length - spread + 1), words=True, hashes=karp_rabin)


def remove_repeated_windows(docs: DataFrame, length: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, n_symbols, spans, kept`` of every row, in words (see ``windows.cut_repeats``)."""
    return cut_repeats(docs, word_scheme(length), ordered=True, label="substring-dedup", key=key, text=text)


def op3_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: words covered by 50-word windows that start in an earlier document are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = remove_repeated_windows(docs)
    return cut.select(
        "row.doc_id",
        F.col("n_symbols").alias("n_words"),
        removed_symbols().alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.size("spans").alias("n_spans"),
    )
