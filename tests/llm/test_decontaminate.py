"""Benchmark decontamination against a plain string tiling."""

import random

import numpy as np
import pytest

from catalink.llm import decontaminate as D


def plain_tiling(item, doc, least):
    """Greedy string tiling by direct comparison; the length covered in each round."""
    free_a, free_b, lengths = [True] * len(item), [True] * len(doc), []
    while True:
        best = 0
        matches = []
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best:
                    best, matches = k, [(i, j)]
                elif k == best and k:
                    matches.append((i, j))
        if best < least:
            return lengths
        for i, j in matches:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = [False] * best
                free_b[j : j + best] = [False] * best
                lengths.append(best)


@pytest.mark.parametrize("seed", range(8))
def test_tiles_against_plain_tiling(seed):
    rng = random.Random(seed)
    item = [rng.randrange(4) for _ in range(30)]
    doc = [rng.randrange(4) for _ in range(20)] + item[15:25] + [9, 8] + item[:12] + [rng.randrange(4) for _ in range(10)]
    tiles = D.tile(np.array(item, np.uint64), np.array(doc, np.uint64), 4)
    for i, j, n in tiles:
        assert item[i : i + n] == doc[j : j + n] and n >= 4
    taken_a = [p for i, _, n in tiles for p in range(i, i + n)]
    taken_b = [p for _, j, n in tiles for p in range(j, j + n)]
    assert len(taken_a) == len(set(taken_a)) and len(taken_b) == len(set(taken_b))
    assert [n for *_, n in tiles] == plain_tiling(item, doc, 4)


ITEM = "The quick brown fox jumps over the lazy dog, while seven wizards quietly juggle frozen blue lamps. Then nobody laughs at all today."


def corpus(spark):
    first, second, third = ITEM[:41], ITEM[41:98], ITEM[98:]
    rows = [
        (1, f"intro words here {ITEM} and an end"),
        (2, f"{third} between {second.upper()} other {first}"),  # reordered, other case
        (3, "nothing of it at all in this clean text"),
        (4, ITEM[:30]),  # a short quotation
        (5, None),
        (6, ""),
        (1, f"intro words here {ITEM} and an end"),
        (None, ITEM.replace(",", " -- ")),
        (7, "yes"),
    ]
    return spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, item_id int, coverage string")


def test_pairs_and_edge_cases(spark):
    items = spark.createDataFrame([(10, ITEM), (11, None), (12, ""), (13, "yes"), (14, "!!")], "item_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id) for r in D.contaminated_pairs(corpus(spark), items).collect())
    assert got == [(-1, 10), (1, 10), (1, 10), (2, 10), (7, 13)]
    clean = D.drop_contaminated(corpus(spark), items)
    assert clean.columns == corpus(spark).columns
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6]
    reordered = [r for r in D.contaminated_pairs(corpus(spark), items).collect() if r.doc_id == 2][0]
    assert reordered.n_tiles >= 3 and reordered.coverage > 0.9


def test_benchmark_in_many_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(10, ITEM), (13, "yes"), (15, "some other item that is nowhere")], "item_id long, text string")
    whole = sorted(map(str, D.contaminated_pairs(corpus(spark), items).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 20)
    assert sorted(map(str, D.contaminated_pairs(corpus(spark), items).collect())) == whole
    assert sorted(r.doc_id for r in D.drop_contaminated(corpus(spark), items).collect()) == [3, 4, 5, 6]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    assert D.contaminated_pairs(none, items).collect() == []
    assert D.contaminated_pairs(corpus(spark), items.limit(0)).collect() == []
    assert D.drop_contaminated(corpus(spark), items.limit(0)).count() == 9


def test_query_finds_every_verbatim_item(spark, sf_dir, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in D.op2_string_tiling(spark, sf_dir).collect()}
    assert got == {(i, k) for i, t in documents for k, x in items if x in t}


FOREIGN = {
    20: "Él señaló aquí mismo: ¿cómo explicará mañana Íñigo la pérdida trágica según cuántos árbitros españoles están allí también?",
    21: "Über große Straßen fährt täglich früh Jürgens müder Käufer, während schöne Vögel größere Bäume fröhlich überqueren müssen.",
    22: "The “quick” answer is that nobody’s lamp was ever lit before seven tired wizards came home for supper",
}


def test_letters_of_any_case_and_signs_of_any_kind(spark):
    items = spark.createDataFrame(list(FOREIGN.items()), "item_id long, text string")
    rows = [
        (1, FOREIGN[20].upper()),
        (2, FOREIGN[21].upper()),
        (3, FOREIGN[21].lower().replace(" ", "\u00a0")),
        (4, FOREIGN[22].replace(" ", "\u2014")),  # dashes between all words
        (5, FOREIGN[22].replace("“", '"').replace("”", '"').replace("’", "'")),
        (6, "«" + "…».«".join(FOREIGN[20].split()) + "»"),
        (7, "Él señaló nada más, y über große Straßen fährt niemand"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = D.contaminated_pairs(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in found) == [
        (1, 20, 1.0), (2, 21, 1.0), (3, 21, 1.0), (4, 22, 1.0), (5, 22, 1.0), (6, 20, 1.0)
    ]
    assert [tuple(r) for r in D.drop_contaminated(docs, items).collect()] == [rows[6]]
