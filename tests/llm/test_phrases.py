"""Phrase mining against SQL on the given table, and against a full count on small corpora."""

import collections
import random
import re

import pytest

from catalink.llm import phrases
from catalink.llm.phrases import OP13_SQL, mine_phrases, op13_phrases, tokenise
from oracle_harness import duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_count, top):
    counts, sizes = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, 6):
                    if i + m <= len(words):
                        counts[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        held = collections.Counter()
        for p, n in f.items():
            for part in (p[1:], p[:-1]):
                held[part] = max(held[part], n)
        rows = []
        for p, a in f.items():
            if len(p) > 1 and a >= min_count and held[p] < a:
                score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def test_query(spark, sf_dir):
    df = op13_phrases(spark, sf_dir)
    assert df.dtypes[:3] == [("lang", "string"), ("rank", "bigint"), ("phrase", "string")]
    assert sorted(map(tuple, df.collect())) == sorted(duck(sf_dir).execute(OP13_SQL).fetchall())


def corpus(seed, languages=("en", None, "fr")):
    rng = random.Random(seed)
    words = [f"w{k}" if k % 3 else f"É{k}" for k in range(60)]
    fixed = [" ".join(rng.choices(words, k=rng.randint(2, 7))) for _ in range(12)]
    docs = []
    for _ in range(120):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, [1 / (k + 1) ** 1.3 for k in range(60)], k=rng.randint(0, 9))) for _ in range(rng.randint(0, 6))]
        docs.append((rng.choice(languages), "".join(p + rng.choice([". ", " ", "\n", ",", "\t", "\x0b"]) for p in parts)))
    return docs


@pytest.mark.parametrize("seed,top,factor", [(1, 5, 6), (2, 1000, 16)])
def test_small_corpora(spark, seed, top, factor):
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, n int, phrase string").repartition(2)
    got = sorted(tuple(r) for r in mine_phrases(df, min_count=3, top=top, block_bytes=1500, level_factor=factor).collect())
    assert got == brute(docs, 3, top)


def test_settles_early(spark, monkeypatch):
    """Rare words give the best phrases; the rounds for common words are not run."""
    grown = []
    pairs = phrases.pairs_of_level
    monkeypatch.setattr(phrases, "pairs_of_level", lambda blocks, level: grown.append(level) or pairs(blocks, level))
    docs = [("en", f"rare{i % 9}a rare{i % 9}b. the the of the") for i in range(40)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(tuple(r) for r in mine_phrases(df, min_count=3, top=2, level_factor=4).collect()) == brute(docs, 3, 2)
    assert grown == [0]


def test_one_language_settles_before_the_other(spark):
    docs = [("en", f"rare{i % 9}a rare{i % 9}b. the the of the of") for i in range(40)] + corpus(5, ("fr",))
    df = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(tuple(r) for r in mine_phrases(df, min_count=3, top=2, level_factor=6).collect()) == brute(docs, 3, 2)


def test_edge_cases(spark):
    docs = [(None, None), ("en", ""), ("en", "  \t .,"), ("x", "A b"), ("x", "a B"), ("x", "a b a b"), ("x", "long " * 30_000), ("und", "q r"), (None, "q r")]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(tuple(r) for r in mine_phrases(df, min_count=2).collect()) == brute(docs, 2, 2000)
    assert mine_phrases(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_counts_beyond_64_bits(spark):
    big = 3_000_000_000_000
    candidates = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, size int, f long")
    words = spark.createDataFrame([("en", "a", big + 1), ("en", "b", big + 7)], "lang string, phrase string, f long")
    sizes = spark.createDataFrame([("en", 90 * big)], "lang string, n long")
    row = phrases.scored(candidates, candidates, words, sizes).first()
    assert row.score == 1000 * big * 90 * big // ((big + 1) * (big + 7))


def test_tokenise():
    words, tokens = tokenise("Ab ab,É\tx\n\n..y".encode())
    assert [words[t].as_py() if t >= 0 else None for t in tokens] == ["ab", "ab", None, "É", "x", None, "y"]
    assert tokenise(b"")[1].tolist() == []


def test_words_are_counted_and_placed_without_a_join(spark):
    """A word common to every block is looked up nowhere: its own rows bring its count."""
    lists = [("en", ["the", "a", f"x{b}"], [5, 1, 9]) for b in range(40)] + [("fr", ["the", "a"], [2, 1])]
    blocks = spark.createDataFrame([(b << 32, *row) for b, row in enumerate(lists)], "block long, lang string, words array<string>, times array<long>")
    places = phrases.word_places(blocks.repartition(7), 6, 4).localCheckpoint()
    assert "Join" not in phrases.word_places(blocks, 6, 4)._jdf.queryExecution().optimizedPlan().toString()
    words = {r.id: r for r in phrases.frequent_words(places).collect()}
    want = {("en", "the"): 200, ("en", "a"): 40} | {("en", f"x{b}"): 9 for b in range(40)}
    assert {(r.lang, r.phrase): r.f for r in words.values()} == want
    assert len(words) == len(want) and {r.phrase: r.level for r in words.values() if r.phrase in ("the", "a", "x3")} == {"the": 2, "a": 1, "x3": 0}
    got = [(r.of >> 32, r.at, words[r.id].phrase, r.level) for r in places.collect()]
    assert sorted(got) == sorted((b, at, w, {"the": 2, "a": 1}.get(w, 0)) for b, (lang, ws, _) in enumerate(lists) for at, w in enumerate(ws) if lang == "en")
