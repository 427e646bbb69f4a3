"""Token alignment against a walk over every token, and against the tokenizers on whole texts."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from catalink.llm.token_alignment import (
    align, align_documents, alignment_summary, all_links, byte_of_char, counted_pairs, aligned_blocks, group_sizes, id_map, op12_run_skipping,
)


@pytest.fixture(scope="module")
def tokenizers_():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def walk(a_end, b_end):
    """Sizes of the groups and all links, token by token."""
    groups, links, i, j, i0, j0 = [], [], 0, 0, 0, 0
    while i < len(a_end):
        links.append((i, j))
        if a_end[i] == b_end[j]:
            i, j = i + 1, j + 1
            groups.append((i - i0, j - j0))
            i0, j0 = i, j
        elif a_end[i] < b_end[j]:
            i += 1
        else:
            j += 1
    return groups, links


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 40)), min_size=1, max_size=30))
def test_align(parts):
    a, b, at = [], [], 0
    for kind, n in parts:  # one to one stretches, and stretches in which either side is finer
        for _ in range(n):
            if kind in (1, 3):
                a.append(at + 1)
            if kind in (2, 3):
                b.append(at + 2)
            at += 3
            a.append(at)
            b.append(at)
    cuts, links = align(np.array(a), np.array(b))
    groups, want = walk(a, b)
    assert list(zip(*(x.tolist() for x in group_sizes(cuts)), strict=True)) == groups
    assert sorted(zip(*(x.tolist() for x in all_links(cuts, links)), strict=True)) == sorted(want)
    assert len(want) == len(a) + len(b) - len(groups)


def brute(docs, tokenizers_):
    """Expected rows of ``(id, text)``."""
    tk, sp = tokenizers_
    chars, entries = byte_of_char(), {i: e for e, i in tk.get_vocab().items()}
    piece = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    held, rows = collections.Counter(), []
    for key, text in docs:
        a = tk.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        a_bytes, b_bytes = [bytes(chars[c] for c in entries[i]) for i in a], [piece(i) for i in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            rows.append((key, 0, 0, 0, [], ""))
            continue
        groups, links = walk(np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes]))
        parts, i, j = [], 0, 0
        for n, m in groups:
            parts.append(f"{','.join(map(str, a[i : i + n]))}|{','.join(map(str, b[j : j + m]))}")
            i, j = i + n, j + m
        linked = [(a[x], b[y]) for x, y in links]
        held.update(set(linked))
        rows.append((key, len(a), len(b), len(groups), linked, hashlib.sha256(";".join(parts).encode()).hexdigest()))
    most = collections.defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for key, n_a, n_b, n_groups, linked, digest in rows:
        best = sum(held[p] == most[p[0]] for p in linked)
        out.append((key, n_a, n_b, n_groups, len(linked), best, sum(held[p] for p in linked), digest))
    return out, held, most


def test_query(spark, sf_dir, documents, tokenizers_):
    df = op12_run_skipping(spark, sf_dir)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, df.collect())) == sorted(brute(documents, tokenizers_)[0])


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "trail  \n", "\n", "\n\nx", "a\n b", "a \n\t b", "x\ty\t", "tab\t\tand  runs   of    spaces",
    "<|endoftext|> <s>a</s><unk><0x41>", "nul\x00x", "it's  we'll don't", "▁a ▁", "a▁ b", "\r\nx ;\r y", "x\r\n\r\n y", "\x1c\x1d a\x85b\xa0 c",
    "é́ ﬁ ①  日本語 𝒳", "　wide  line", "word" * 30_000, "many words " * 9_000, "12345 67,8.9 !!! ??", "﻿bom",
]


def test_odd_texts(spark, tokenizers_):
    rows = [(i, t, 1, "n", "p") for i, t in enumerate(ODD)] + [(None, "a b", 2, "n", "p"), (3, ODD[3], 2, "n", "p"), (None, "a b", 2, "n", "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, block int, pairs string, `at` string")
    want, held, most = brute([r[:2] for r in rows], tokenizers_)
    got = [tuple(r) for r in alignment_summary(df).collect()]
    order = lambda r: (r[0] is None, r)
    assert sorted(map(repr, got)) == sorted(map(repr, want)), order
    table = id_map(counted_pairs(aligned_blocks(df.selectExpr("doc_id AS id", "text")))).collect()
    assert {(r.a_id, r.b_id): (r.docs, r.best) for r in table} == {p: (n, n == most[p[0]]) for p, n in held.items()}


def test_real_output(spark, tokenizers_):
    texts = ["Alpha beta, gamma's δέλτα.", "", None]
    got = {r.id: r for r in align_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    a, b = tokenizers_
    assert got[0].a_ids == a.encode(" " + texts[0], add_special_tokens=False).ids and got[0].b_ids == b.encode(texts[0])
    assert sum(got[0].a_sizes) == len(got[0].a_ids) and sum(got[0].b_sizes) == len(got[0].b_ids)
    assert got[1].a_ids == got[2].b_sizes == []


def test_empty_table(spark):
    assert alignment_summary(spark.createDataFrame([], "doc_id long, text string")).collect() == []
