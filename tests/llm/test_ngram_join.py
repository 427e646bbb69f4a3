"""N-gram Jaccard join and components against brute force."""

import collections
import random

import pytest

from catalink.llm.components import components
from catalink.llm.ngram_join import keep_one_per_component, op4_ngram_join, similarity_components, similarity_join
from catalink.llm.staging import stage_area

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_sets(rows, n=5):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(FOLD).split()
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    return sets


def brute(rows, n=5, percent=75):
    """``{id: (set size, component)}`` for unique ids."""
    sets = shingle_sets(rows, n)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if both and 100 * both >= percent * either:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def made_documents(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
    passage = [word() for _ in range(30)]
    rows += [" ".join([word() for _ in range(rng.randint(1, 12))] + passage) for _ in range(25)]
    rows += [None, "", " \n", "a b", "A  b", "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = made_documents(seed)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, size int, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similarity_components(df).collect()}
    want = brute(rows)
    assert got == want
    assert 5 < len({c for _, c in want.values()}) < len(want)


@pytest.mark.parametrize("percent", [75, 40])
def test_join_gives_every_link_with_its_overlap(spark, percent):
    rows = made_documents(3)
    rows += [(1000 + k, rows[k % 20][1]) for k in range(60)]  # copies
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, node long, class_id int")
    members, links = similarity_join(df, percent=percent)
    sets = shingle_sets(rows)
    linked = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    got = members.collect()
    class_of = {r.doc_id: r.class_id for r in got}
    assert len(got) == len(rows) and {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.n_links for r in got} == {
        i: sum(1 for j in sets if j != i and linked(s, sets[j])) for i, s in sets.items()
    }
    least = {}
    for i in sorted(sets):
        if sets[i]:
            least.setdefault(frozenset(sets[i]), i)
    reps = sorted(least.values())
    want = {(a, b): len(sets[a] & sets[b]) for a in reps for b in reps if a < b and linked(sets[a], sets[b])}
    found = links.collect()
    assert {(min(r.id_x, r.id_y), max(r.id_x, r.id_y)): r.overlap for r in found} == want
    assert len(found) == len(want) > 20
    for r in found:
        assert (class_of[r.id_x], class_of[r.id_y]) == (r.class_x, r.class_y)
        assert (r.n_x, r.n_y) == (len(sets[r.id_x]), len(sets[r.id_y]))


def test_join_of_nothing_and_of_rows_without_an_id(spark):
    members, links = similarity_join(spark.createDataFrame([], "doc_id long, text string"))
    assert members.collect() == [] and links.collect() == []
    text = "one two three four five six seven"
    df = spark.createDataFrame([(None, text), (None, text), (3, text), (3, None), (None, "")], "doc_id long, text string")
    members, links = similarity_join(df)
    rows = members.collect()
    assert links.collect() == [] and sorted(r.n_links for r in rows) == [0, 0, 2, 2, 2]
    assert all((r.class_id is None) == (r.n_links == 0) for r in rows)


def test_query_against_brute_force(spark, sf_dir, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op4_ngram_join(spark, sf_dir).collect()}
    assert got == brute(documents)


def test_one_row_of_each_component_stays(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text, "b"), (3, text, "a"), (3, text, "a"), (None, None, "n"), (9, "", "e"), (10, "", "e"), (7, "other words here", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = keep_one_per_component(df)
    assert kept.columns == df.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter([None, 3, 7, 9, 10])


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert similarity_components(none).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(139, 200), (50, 51), (50, 50)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df, stage_area(spark, "test"), "t").collect()}
    want = {**dict.fromkeys(range(31), 0), **dict.fromkeys([*range(100, 140), 200], 100), 50: 50, 51: 50}
    assert got == want


def test_rows_without_an_id_or_with_a_shared_one_are_linked_by_text_alone(spark):
    rng = random.Random(5)
    fresh = lambda: [f"w{rng.randrange(10**6)}" for _ in range(40)]
    distinct = [" ".join(fresh()) for _ in range(30)]
    rows = [(None, t, "null") for t in distinct[:15]] + [(4, t, "same") for t in distinct[15:]]
    left, right = fresh(), fresh()  # two clusters that rows of one id link to
    clusters = [(4, left), (20, [*left[:-1], "x"]), (21, ["y", *left[1:]]), (4, right), (30, [*right[:-1], "x"]), (None, [*right, "z"])]
    rows += [(i, " ".join(w), "cluster") for i, w in clusters]
    rows += [(None, distinct[0], "copy"), (None, None, "empty"), (None, "", "empty"), (4, " ", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = [tuple(r) for r in keep_one_per_component(df).collect()]
    texts = collections.Counter(t for _, t, _ in kept)
    assert texts == collections.Counter([*distinct, " ".join(left), " ".join([*right, "z"]), None, "", " "])
    named = similarity_components(df).collect()
    assert {r.component_id for r in named if r.doc_id in (20, 21)} == {4}
    assert {r.component_id for r in named if r.doc_id == 30} == {None}
    assert len(named) == len(rows)
