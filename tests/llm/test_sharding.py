"""Jump consistent hashing against the published loop."""

import collections
import zlib

from catalink.llm.sharding import op7_jump_shards, shard_rows


def jump(key, shards):
    key &= (1 << 64) - 1
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        to = int(float(at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_query(spark, sf_dir, documents):
    rows = op7_jump_shards(spark, sf_dir).collect()
    texts = dict(documents)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = collections.defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r.shard == jump(r.doc_id, 40) and r.grown_shard == jump(r.doc_id, 41)
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edge_cases(spark):
    keys = [0, 1, -1, -(1 << 63), (1 << 63) - 1, 5, 5, 5, None, None]
    rows = [(k, None if i == 0 else "t" * (i % 3), "s", 1.5) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot double")
    got = shard_rows(df, 7).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(keys)
    assert all(r.shard == jump(r.doc_id or 0, 7) and r.grown_shard == jump(r.doc_id or 0, 8) for r in got)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert [r.size for r in got if r.doc_id == 0] == [16]
    assert shard_rows(df.limit(0), 7).collect() == []
    assert {r.shard for r in shard_rows(df, 1).collect()} == {0}


def test_a_new_shard_takes_its_share_only(spark):
    df = spark.range(20000).selectExpr("id * 7 AS doc_id", "'x' AS text")
    rows = shard_rows(df, 40).collect()
    moved = sum(r.shard != r.grown_shard for r in rows)
    assert 0.6 * 20000 / 41 < moved < 1.5 * 20000 / 41
    sizes = collections.Counter(r.shard for r in rows)
    assert len(sizes) == 40 and max(sizes.values()) < 1.4 * 500 and min(sizes.values()) > 0.6 * 500
