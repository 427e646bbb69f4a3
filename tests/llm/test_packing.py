"""Tokenising and packing against the tokenizer itself and best-fit decreasing."""

import bisect
import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalink.llm.packing import op5_best_fit, pack, pack_documents, packed_sequences, sweep_plan


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def pieces_of(tokenizer, text, capacity):
    ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    return [
        (k, a, len(ids[a : a + capacity]), zlib.crc32(ids[a : a + capacity].tobytes()))
        for k, a in enumerate(range(0, len(ids), capacity))
    ]


def assert_packed(rows, capacity):
    """Sequences are gapless and within the capacity; their number is that of best-fit decreasing or better."""
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for spans in held.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    free, opened = [], 0
    for length in sorted((r.length for r in rows), reverse=True):
        k = bisect.bisect_left(free, length)
        gap = free.pop(k) if k < len(free) else capacity
        opened += gap == capacity
        bisect.insort(free, gap - length)
    assert len(held) == opened


def test_query(spark, sf_dir, documents, tokenizer):
    rows = op5_best_fit(spark, sf_dir).collect()
    got = collections.defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {i: pieces_of(tokenizer, t, 2048) for i, t in documents}
    assert_packed(rows, 2048)


def test_edge_cases_and_odd_texts(spark, tokenizer):
    odd = [
        None, "", "   \n", "Word word. WORD, word's don't <|endoftext|> x<|startoftext|>y", "naïve é   \x85   İstanbul ΣΑΣ",
        "1234 a1b2 ... !?# https://x.example/a_b", "\x1c\x1d a\x0bb\x0cc", "long " * 700, "word" * 500, "Ünï. ß, é.", "a,. b.. .c ,",
    ]
    rows = [(i, t, 3, "z") for i, t in enumerate(odd)] + [(7, odd[7], 4, "z"), (None, "no id", 5, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, bucket string")
    got = pack_documents(df, capacity=64).collect()
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.id].append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in enumerate(odd):
        want = pieces_of(tokenizer, t, 64) * (2 if i == 7 else 1)
        assert sorted(by_id[i]) == sorted(want), t
    assert len(by_id[None]) == 1
    assert_packed(got, 64)


def test_sequences_hold_the_ids(spark, tokenizer):
    texts = ["alpha beta gamma", "delta", "epsilon zeta " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packed_sequences(df, capacity=32).collect()
    every = collections.Counter(x for r in rows for x in r.ids)
    want = collections.Counter(x for t in texts for x in [*tokenizer.encode(t, add_special_tokens=False).ids, 0])
    assert every == want and all(len(r.ids) <= 32 for r in rows)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_sound_and_tight(seed):
    rng = random.Random(seed)
    capacity = 100
    top = [100, 50, 30, 60, 20, 100][seed]
    counts = {k: rng.randint(0, 400) for k in range(1 + (seed == 5) * 33, top + 1) if rng.random() < 0.7}
    plan = sweep_plan(counts, capacity)
    rank = collections.Counter()
    rows = list(zip(plan.length.tolist(), plan.rank.tolist(), plan.sequence.tolist(), plan.offset.tolist(), strict=True))
    held = collections.defaultdict(list)
    for k, (length, start, sequence, offset) in enumerate(rows):
        assert start == rank[length]
        end = rows[k + 1][1] if k + 1 < len(rows) and rows[k + 1][0] == length else counts[length]
        for j in range(end - start):
            held[sequence + j].append((offset, length))
        rank[length] = end
    assert rank == collections.Counter({k: n for k, n in counts.items() if n})
    for spans in held.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    free, opened = [], 0
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        k = bisect.bisect_left(free, length)
        gap = free.pop(k) if k < len(free) else capacity
        opened += gap == capacity
        bisect.insort(free, gap - length)
    assert len(held) == opened


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    none = spark.createDataFrame([], "id long, piece int, length long, ids_crc32 long")
    assert pack(none).collect() == []
