"""Quality rules: counts against brute force, adaptive verdicts on planted junk."""

import collections
import random
import re

from catalink.llm import quality as Q


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    seen = collections.Counter(grams)
    repeated = set()
    for k, g in enumerate(grams):
        if seen[g] > 1:
            repeated |= {k, k + 1, k + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines), len(lines) - len(set(lines)), len(repeated)


ODD = [None, "", "\n\n", " a \n a \n a", "é\né\nü é", "a b c a b c\n a b c\na b c", "x\r\nx\r\nx", "# * | < > $ % &", "a\x0bb\x1cc\x85d", "tail\n"]


def test_counts_against_brute_force(spark, documents):
    rows = [(i, t, "n", 1) for i, t in enumerate([*ODD, *(t for _, t in documents)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, n_lines int")
    got = Q.document_counts(df, "doc_id long").collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_counts(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == want


def test_query_base_rules_and_clean_documents(spark, sf_dir, documents):
    texts = dict(documents)
    got = Q.op6_adaptive_rules(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        n, chars, symbols, _, dup, repeat = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (r.base_failed and r.kept)
        if not r.base_failed and symbols == 0 and dup == 0 and repeat == 0:
            assert r.kept, r


def planted(n=400):
    rng = random.Random(8)
    word = lambda size: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(*size)))
    rows = []
    for i in range(n):
        lang, size = ("aa", (2, 7)) if i % 2 else ("bb", (7, 15))  # what is long in one language is usual in the other
        text = " ".join(word(size) for _ in range(rng.randint(60, 200)))
        rows.append((i, text, lang, f"s{i % 4}", 0.5))
    rows.append((9001, " ".join(word((2, 7)) + "###" for _ in range(100)), "aa", "s1", 0.5))
    rows.append((9002, " ".join(word((25, 30)) for _ in range(100)), "aa", "s1", 0.5))
    rows.append((9003, " ".join(word((7, 15)) for _ in range(100)), "aa", "s3", 0.5))  # long words for its language
    rows.append((9004, "\n".join(["the same line again"] * 40), "bb", "s0", 0.5))
    rows.append((9005, None, None, None, None))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, kept double"


def test_thresholds_adapt_to_language_and_source(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    gone = {k for k, r in got.items() if not r.kept}
    assert gone == {9001, 9002, 9003, 9004, 9005}
    assert not got[9001].base_failed and not got[9003].base_failed and got[9004].base_failed


def test_small_groups_take_the_merged_sketches(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    counts = Q.document_counts(df, "doc_id long, lang string, source string")
    rows = {(r.lang, r.source): r for r in Q.thresholds(counts, min_docs=150).collect()}
    assert rows["aa", "s1"].mean_word_chars_high == rows["aa", "s3"].mean_word_chars_high  # both from the language
    assert rows["aa", "s1"].mean_word_chars_high < rows["bb", "s0"].mean_word_chars_high
    own = {(r.lang, r.source): r for r in Q.thresholds(counts, min_docs=10).collect()}
    assert own["aa", "s1"].mean_word_chars_high != own["aa", "s3"].mean_word_chars_high
    assert (None, None) in rows


def test_filter_keeps_rows_and_columns(spark):
    df = spark.createDataFrame(planted() + planted()[:3], SCHEMA)
    kept = Q.filter_documents(df)
    assert kept.columns == df.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert set(ids) == set(range(400)) and ids[0] == ids[1] == ids[2] == 2


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert Q.quality_rules(none.drop("kept")).collect() == []
    assert Q.filter_documents(none).collect() == []


def junk_heavy():
    """A clean source, one that is 30 % symbol junk, and one with a few documents of repeated lines."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 7)))
    lines = lambda: [" ".join(word() for _ in range(10)) for _ in range(10)]
    rows = [(i, "\n".join(lines()), "aa", "clean", 0.5) for i in range(900)]
    rows += [(1000 + i, "\n".join(lines()), "aa", "hot", 0.5) for i in range(280)]
    rows += [(2000 + i, " ".join(word() + "###" for _ in range(100)), "aa", "hot", 0.5) for i in range(120)]
    for i in range(10):  # a short line again and again, far beyond the language's tail, and no words repeated in a row
        rows.append((3000 + i, "\n".join(f"{x}\nread on" for x in lines()[:5]), "aa", "clean", 0.5))
    return rows


def test_source_full_of_junk_does_not_switch_its_rules_off(spark):
    df = spark.createDataFrame(junk_heavy(), SCHEMA)
    gone = {r.doc_id for r in Q.quality_rules(df).collect() if not r.kept}
    assert {i for i in gone if i < 2000} == set()
    assert {i for i in gone if 2000 <= i < 3000} == set(range(2000, 2120))


def test_rooms_come_from_the_far_tail_of_the_language(spark):
    df = spark.createDataFrame(junk_heavy(), SCHEMA)
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    assert not any(got[i].base_failed or got[i].kept for i in range(3000, 3010))
    counts = Q.document_counts(df, "doc_id long, lang string, source string")
    for r in Q.thresholds(counts).collect():
        for rule, (_, side, slack) in Q.RULES.items():
            assert side == "both" or slack / 2 <= r[f"{rule}_high"] <= slack < 1


def test_language_full_of_junk_takes_the_fence_of_the_corpus(spark):
    rows = junk_heavy()
    rows += [(5000 + r[0], r[1], "zz", "only", 0.5) for r in rows if r[3] == "hot"]
    gone = {r.doc_id for r in Q.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect() if not r.kept}
    assert {i for i in gone if i > 5000} == set(range(7000, 7120))
