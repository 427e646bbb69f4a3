"""Archives: the query against SQL, round trips of odd pages, members and index by hand."""

import base64
import collections
import gzip
import hashlib
import zlib

import pytest

from catalink.llm.warc import (
    EMPTY_MEMBER, OP11_SQL, RECORD_END, cut_records, inflated, lookup, member, normalise, op11_gzip_members,
    read_index, read_records, write_archives,
)
from oracle_harness import duck


def base32(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def test_query(spark, sf_dir):
    df = op11_gzip_members(spark, sf_dir)
    assert df.dtypes == [
        ("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint"),
    ]
    want = duck(sf_dir).execute(OP11_SQL).fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


ODD = [
    (1, "http://a/", "same"),
    (2, "http://b/", "same"),
    (2, "http://c/", "other"),
    (3, None, None),
    (4, "", ""),
    (5, "http://x/\r\nWARC-Type: warcinfo", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (None, "http://n/", "same"),
    (None, "http://n/", "alone"),
    (None, "http://n/", "alone"),
    (7, "http://t/ ", "tie"),
    (7, "http://u/", "tie"),
    (8, "http://l/é", "é 𝒳\x00\n" * 90_000),
]


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warc")
    rows = [(i, u, p, "s", 1, "k") for i, u, p in ODD]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, size int, keeper string").repartition(3)
    write_archives(df, f"{root}/whole", records_per_file=3)
    normalise(spark, f"{root}/whole", f"{root}/members")
    return root


def test_odd_pages(spark, places):
    got = read_records(spark, f"{places}/members").collect()
    keeper = {}
    for i, _, p in ODD:
        if i is not None:
            keeper[p or ""] = max(i, keeper.get(p or "", i))
    want = collections.Counter()
    for i, u, p in ODD:
        text = p or ""
        refers = keeper.get(text) if keeper.get(text) != i else None
        url = None if u is None else u.replace("\r", "%0D").replace("\n", "%0A")
        kind = "response" if refers is None else "revisit"
        body = text.encode() if refers is None else None
        want[None if i is None else str(i), url, len(text.encode()), base32(text), kind, None if refers is None else str(refers), body] += 1
    assert want == collections.Counter(
        (r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
        for r in got
    )


def test_members_and_index(spark, places):
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((places / "whole").glob("*.gz")))
    files = {f.name.split(".")[0]: f.read_bytes() for f in (places / "members/archives").glob("*.warc.gz")}
    plain = b"".join(gzip.decompress(raw) for raw in files.values())
    assert sorted(cut_records(iter([whole]))) == sorted(cut_records(iter([plain])))
    index = read_index(spark, f"{places}/members").collect()
    assert len(index) == len(ODD)
    for r in index:
        one = zlib.decompressobj(wbits=31)
        record = one.decompress(files[r.file][r.offset : r.offset + r.length])
        assert one.eof and not one.unused_data
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(RECORD_END.encode())
    read = read_records(spark, f"{places}/members").collect()
    assert {(r.file, r.offset, r.length, r.record_id) for r in index} == {(r.file, r.offset, r.length, r.record_id) for r in read}


def test_lookup(spark, places):
    wanted = read_index(spark, f"{places}/members").where("page_id = '2' OR record_type = 'revisit'")
    got = lookup(spark, f"{places}/members", wanted).collect()
    assert sorted((r.page_id or "", r.record_type) for r in got) == [("", "revisit"), ("1", "revisit"), ("2", "response"), ("2", "response"), ("3", "revisit")]


def test_payload_floor_and_empty_table(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w", min_payload=3)
    normalise(spark, f"{tmp_path}/w", f"{tmp_path}/m")
    got = {r.page_id: (r.record_type, r.refers_to) for r in read_records(spark, f"{tmp_path}/m").collect()}
    assert got == {"1": ("response", None), "2": ("response", None), "3": ("revisit", "4"), "4": ("response", None)}
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/e")
    normalise(spark, f"{tmp_path}/e", f"{tmp_path}/n")
    assert read_records(spark, f"{tmp_path}/n").collect() == [] == read_index(spark, f"{tmp_path}/n").collect()


def test_streams():
    records = [f"WARC/1.1\r\nContent-Length: {n}\r\n\r\n{'x' * n}\r\n\r\n".encode() for n in (0, 1, 300_000, 5)]
    one = gzip.compress(b"".join(records))
    many = EMPTY_MEMBER.join(map(member, records)) + EMPTY_MEMBER
    for content in (one, many):
        assert list(cut_records(inflated(content))) == records
        with pytest.raises((ValueError, zlib.error)):
            list(cut_records(inflated(content[: len(content) // 2])))
    with pytest.raises(ValueError):
        list(cut_records(iter([records[1] + b"rest"])))
    with pytest.raises(ValueError):
        list(cut_records(iter([b"WARC/1.1\r\nX: 1\r\n\r\n"])))
    assert gzip.decompress(EMPTY_MEMBER) == b""
