"""Suffix-array dedup by bucket-pointer refinement over bytes.

Suffixes are bucketed by their first q-gram, and a bucket's identifier at a
position is refined with the identifiers at later offsets:
``bucket_2m(p) = (bucket_m(p), bucket_m(p + m))``.  Each refinement reuses the
identifiers the previous one made, so ``length`` bytes take about
``log2(length)`` of them.  Identifiers are hashes, hence the same in every
task, and equality of buckets is all that dedup needs of the order.

Spark sorts the suffixes by these identifiers in four rounds (see
``windows``): by the bucket of an anchored suffix's core, where suffixes alone
in their bucket leave; by the pair of that bucket and the buckets at the first
and last offset of the run; for what is still open, by the same pair for parts
of the run; and last by the bucket of each single suffix.  Every byte covered by a ``length``-byte string that also
starts anywhere else, in the same document or another, is removed.

Edge cases: a null text is empty; texts shorter than ``length`` bytes keep
everything; all copies of a string go, also those in repeated rows; a removed
run may cut a multi-byte character, so ``kept`` is bytes, and
``dedup_documents`` drops the torn character; an empty table gives an empty result; other columns
ride along packed in ``row``, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import combine
from .windows import Hashes, Scheme, cut_repeats, removed_symbols


def refine_buckets(sym: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """Bucket identifiers of the first ``lengths`` symbols at every position (ascending lengths)."""
    bucket, size, out = sym, 1, []
    for length in lengths:
        while size * 2 <= length:
            bucket = combine(bucket[: max(0, len(bucket) - size)], bucket[size:])
            size *= 2
        later = length - size  # the last refinement overlaps
        out.append(combine(bucket[: max(0, len(bucket) - later)], bucket[later:]) if later else bucket)
    return out


def bucket_pointers(sym: np.ndarray, s: Scheme) -> Hashes:
    gram, core, inner, string = refine_buckets(sym, [s.gram, s.core, s.inner, s.length])
    return gram, core, inner, string


def byte_scheme(length: int) -> Scheme:
    spread = 1
    while spread * 2 <= max(1, length * 2 // 3):
        spread *= 2
    return Scheme(length=length, spread=spread, gram=min(16, length - spread + 1), words=False, hashes=bucket_pointers)


def remove_repeated_bytes(
    docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text", as_text: bool = False
) -> DataFrame:
    """``row, n_symbols, spans, kept`` of every row, in bytes (see ``windows.cut_repeats``)."""
    return cut_repeats(docs, byte_scheme(length), False, "suffix-dedup", key=key, text=text, as_text=as_text)


def dedup_documents(docs: DataFrame, length: int = 400) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text`` and ``n_chars`` counted anew; other columns unchanged."""
    cut = remove_repeated_bytes(docs, length, as_text=True)
    text = F.when(F.size("spans") > 0, F.col("kept")).otherwise(F.col("row.text"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(text.alias("text"))
        elif name == "n_chars":
            columns.append(F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col("row").getField(name).alias(name))
    return cut.select(*columns)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: bytes covered by 400-byte strings that start more than once are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = remove_repeated_bytes(docs)
    return cut.select(
        "row.doc_id",
        F.col("n_symbols").alias("n_bytes"),
        removed_symbols().alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
