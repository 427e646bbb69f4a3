"""Suffix-array dedup and substring dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from catalink.llm import windows
from catalink.llm.substring_dedup import op3_window_dedup, remove_repeated_windows, word_scheme
from catalink.llm.suffix_dedup import byte_scheme, dedup_documents, op1_suffix_dedup, refine_buckets, remove_repeated_bytes


def brute_bytes(rows, length):
    """Removed mask of every row: strings that start more than once anywhere."""
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        out.append((t, bytes(mask)))
    return out


def brute_words(rows, length):
    """Removed mask of every row: windows that also start in a row with a smaller id."""
    rank = lambda i: (i is not None, i or 0)
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - length + 1):
            key = tuple(w[p : p + length])
            first[key] = min(first.get(key, rank(i)), rank(i))
    out = []
    for i, w in words:
        mask = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < rank(i):
                mask[p : p + length] = [True] * length
        out.append((w, mask))
    return out


def made_documents(seed):
    """Random texts with shared passages, copies, repeats, null, empty and multi-byte parts."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["ab", "ba", "é", "abc", "d", "ee", "x", "yz", "ß", "q"])
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randint(5, 40)) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = [rng.choice([text(rng.randint(0, 30)), rng.choice(shared)]) for _ in range(rng.randint(1, 5))]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(100, None), (101, ""), (102, "a" * 300), (103, rows[3][1]), (104, "  \n "), (3, rows[3][1]), (None, rows[5][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(spark, seed):
    rows = made_documents(seed)
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, id string, spans int")
    got = collections.Counter(
        (r.row.doc_id, r.row.text, r.n_symbols, tuple((s["first"], s["end"]) for s in r.spans), bytes(r.kept))
        for r in remove_repeated_bytes(df, 24).collect()
    )
    want = collections.Counter()
    for (i, t), (raw, mask) in zip(rows, brute_bytes(rows, 24), strict=True):
        spans = tuple(m.span() for m in re.finditer(b"\1+", mask))
        want[(i, t, len(raw), spans, bytes(c for c, gone in zip(raw, mask, strict=True) if not gone))] += 1
    assert got == want
    assert sum(len(k[3]) for k in want) > 20


@pytest.mark.parametrize("seed", [3, 4])
def test_words_against_brute_force(spark, seed):
    rows = made_documents(seed)
    df = spark.createDataFrame([(i, t, 0, "y") for i, t in rows], "doc_id long, text string, n_symbols int, kept string")
    got = collections.Counter(
        (r.row.doc_id, r.n_symbols, sum(s["end"] - s["first"] for s in r.spans), bytes(r.kept))
        for r in remove_repeated_windows(df, 8).collect()
    )
    want = collections.Counter()
    for (i, _), (w, mask) in zip(rows, brute_words(rows, 8), strict=True):
        want[(i, len(w), sum(mask), b" ".join(x for x, gone in zip(w, mask, strict=True) if not gone))] += 1
    assert got == want
    assert sum(k[2] for k in want) > 50


def test_queries_against_brute_force(spark, sf_dir, documents):
    got = {r.doc_id: r for r in op1_suffix_dedup(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for (i, _), (raw, mask) in zip(documents, brute_bytes(documents, 400), strict=True):
        kept = bytes(c for c, gone in zip(raw, mask, strict=True) if not gone)
        want = (len(raw), sum(mask), len(re.findall(b"\1+", mask)), hashlib.sha256(kept).hexdigest())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want
    got = {r.doc_id: r for r in op3_window_dedup(spark, sf_dir).collect()}
    for (i, _), (w, mask) in zip(documents, brute_words(documents, 50), strict=True):
        kept = b" ".join(x for x, gone in zip(w, mask, strict=True) if not gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), sum(mask), hashlib.sha256(kept).hexdigest())


def test_refined_buckets_tell_strings_apart():
    rng = np.random.default_rng(5)
    sym = rng.integers(0, 2, 3000).astype(np.uint64)
    for length, bucket in zip([3, 16, 21], refine_buckets(sym, [3, 16, 21]), strict=True):
        strings = [tuple(sym[p : p + length]) for p in range(len(sym) - length + 1)]
        assert len(bucket) == len(strings)
        assert len(set(zip(strings, bucket.tolist(), strict=True))) == len(set(strings)) == len(set(bucket.tolist()))


@pytest.mark.parametrize("scheme", [byte_scheme(40), word_scheme(50)])
def test_runs_cover_every_string_once_across_slices(scheme, monkeypatch):
    """A text longer than a slice: each start lies in one run, and equal texts give equal strings."""
    monkeypatch.setattr(windows, "_SLICE", 512)
    rng = np.random.default_rng(6)
    sym = rng.integers(0, 1 << 60, 5000).astype(np.uint64)
    off = np.array([0, 10, 1900, 1900, 5000])
    first, last, *_ = windows.block_runs(sym, off, scheme)
    starts = sorted(p for a, b in zip(first, last, strict=True) for p in range(a, b + 1))
    assert starts == [p for a, b in zip(off[:-1], off[1:], strict=True) for p in range(a, b - scheme.length + 1)]
    for got, want in zip(windows.string_hashes(sym, scheme), scheme.hashes(sym, scheme)[2:], strict=True):
        assert (got[: len(want)] == want).all()


def test_cut_documents_keep_their_columns(spark):
    text = "é" * 300
    rows = [(1, text, "en", 300), (2, "x" + text, "de", 301), (3, "clean", "fr", 5), (4, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    got = {r.doc_id: r for r in dedup_documents(df).collect()}
    assert [f.name for f in dedup_documents(df).schema] == df.columns
    assert got[1].text == "" and got[1].n_chars == 0
    assert got[2].text == "x" and got[2].n_chars == 1 and got[2].lang == "de"
    assert got[3].text == "clean" and got[4].text is None and got[4].n_chars is None


def test_texts_without_an_id_whose_short_checksums_collide(spark):
    """The 32-bit checksums of ``plumless`` and ``buckeroo`` are equal, whatever follows both."""
    tail = "".join(random.Random(5).choices("abcdef ", k=90))
    data = [(None, "plumless" + tail), (None, "buckeroo" + tail), (None, "plumless" + tail[:50] + "x" * 60), (4, "other")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(bytes(r.kept) for r in remove_repeated_bytes(df, 40).collect())
    want = sorted(bytes(c for c, gone in zip(raw, mask, strict=True) if not gone) for raw, mask in brute_bytes(data, 40))
    assert got == want


def test_many_equal_rows_without_an_id(spark):
    """A third of a corpus being one text: what is gathered per text does not grow with its copies."""
    text = "".join(random.Random(6).choices("abcdefgh ", k=700))
    alone = "".join(random.Random(7).choices("ijklmnop ", k=500))
    made = spark.range(0, 3000, 1, 4).selectExpr("CAST(null AS LONG) AS doc_id", f"'{text}' AS text")
    df = made.unionByName(spark.createDataFrame([(1, alone)], made.schema))
    rows = windows.keyed(df, "doc_id", "text")
    starts = windows.repeated_starts(rows, byte_scheme(400), False, "test").collect()
    assert len(starts) == 1 and len(starts[0].starts) <= 700
    got = remove_repeated_bytes(df).groupBy("row.doc_id").agg({"n_symbols": "count", "kept": "max"}).collect()
    assert {(r.doc_id, r["count(n_symbols)"], bytes(r["max(kept)"])) for r in got} == {(None, 3000, b""), (1, 1, alone.encode())}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeated_bytes(none).collect() == []
    assert remove_repeated_windows(none).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [bytes(r.kept) for r in remove_repeated_bytes(blank).collect()] == [b"", b""]
