"""The pipeline's stages on their own inputs, against brute force."""

import importlib.util

import pytest

import corpus_pipeline as P
from test_ngram_join import brute
from test_quality import brute_counts
from test_windows import brute_bytes


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    out = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = [docs]
    for name, stage in P.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
        tables.append(docs)
    return tables


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    assert all(t.schema == stages[0].schema for t in stages[1:-1])
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "repeated_strings", "decontaminate", "pack"]


def test_quality(stages):
    before, after = rows(stages[0]), rows(stages[1])
    for i, r in before.items():
        n, _, symbols, _, dup, repeat = brute_counts(r.text)
        if n < 50 or 100 * repeat > 50 * n:
            assert i not in after
        elif not (symbols or dup or repeat):
            assert after[i] == r
    assert 0 < len(after) < len(before)


def test_near_duplicates(stages):
    before, after = rows(stages[1]), rows(stages[2])
    found = brute([(i, r.text) for i, r in before.items()])
    assert after == {i: r for i, r in before.items() if found[i][1] == i}


def test_repeated_strings(stages):
    before, after = rows(stages[2]), rows(stages[3])
    ids = sorted(before)
    for i, (raw, mask) in zip(ids, brute_bytes([(i, before[i].text) for i in ids], P.REPEAT_BYTES), strict=True):
        kept = bytes(c for c, gone in zip(raw, mask, strict=True) if not gone).decode("utf-8", "ignore")
        assert after[i].text == kept and (after[i].n_chars == len(kept) or not any(mask))


def test_decontaminate(spark, stages, sf_dir):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = rows(stages[3]), rows(stages[4])
    assert after == {i: r for i, r in before.items() if not any(x in r.text for x in items)}


def test_pack(stages):
    ids = {r.doc_id for r in stages[4].collect()}
    assert {r.doc_id for r in stages[5].collect()} == ids


def test_run(spark, sf_dir, stages):
    got = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in P.run(spark, sf_dir).collect()}
    assert got == {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in stages[-1].collect()}


def test_empty_and_odd_documents(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, id int"
    odd = [(None, None, None, None, None, "r", 1), (1, "", "en", None, 0, None, None), (1, "", "en", None, 0, None, None)]
    clean = [(k, " ".join(f"w{k}x{j}" for j in range(80)), "en", "s", 7, "r", k) for k in range(5, 9)]
    for data in ([], odd, odd + clean):
        docs = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES:
            out = stage(spark, docs, sf_dir)
            out.collect()
            if name != "pack":
                assert out.columns == docs.columns
        kept = P.quality_rules(spark, docs, sf_dir)
        assert kept.count() == (4 if data and len(data) > 3 else 0)


def test_any_column_names(spark, sf_dir):
    text = " ".join(f"w{j}" for j in range(80))
    docs = spark.createDataFrame(
        [(k, f"{k} {text} {k}", "en", "s", 7, k, "a", "b", "c", "d") for k in range(3)],
        "doc_id long, text string, lang string, source string, n_chars long, row int, `my col` string, `a-b` string, `t``k` string, `d.t` string",
    )
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf_dir)
        assert name == "pack" or out.columns == docs.columns
        assert out.count() == (1 if name == "near_duplicates" else 3), name


def test_entry_registers_everything():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{k}" for k in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
    assert importlib.util.find_spec("catalink.llm") is not None
