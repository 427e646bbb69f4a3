"""WARC archives: writing pages, normalising whole-file gzip, indexing and reading back.

Three steps, each on files of any Hadoop file system:

* ``write_archives`` writes a WARC/1.1 record per page through Spark's text
  writer, whose files are one gzip stream each (its line separator is the two
  line ends that close a record).  Of pages with equal payloads the one with the
  largest id is a ``response``, the others are ``revisit`` records of it.
* ``normalise`` is the monolithic gzip normaliser: a task inflates each file
  once, as a stream, cuts it into records by their ``Content-Length``, rewrites
  every record as a gzip member of its own, and writes a sidecar index of the
  members' offsets beside it (``archives/part-N.warc.gz``, ``index/part-N.cdx.gz``).
* ``read_records`` walks the members; ``lookup`` reads the index and inflates
  only the members asked for.

Writing goes through Spark's commit protocol, so a lost executor leaves nothing
half written.  A task holds one compressed file and a part of the inflated
stream; ``write_archives`` bounds the records a file holds.  Between blocks of
members stands an empty gzip member, which readers skip (the text writer ends
every row with its separator).

Edge cases: a null payload is empty; without an id a page has none in the
archive either and no page refers to it; a group in which no page has an id, and
pages of one payload that share the largest id, are responses all; line ends
in a URL are percent-encoded, a null URL leaves its header out; an empty table
gives archives without a record.  Only id, URL and payload are read, so other
columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import _fs_and_path
from .shipping import ship_package
from .staging import stage_area

RECORD_END = "\r\n\r\n"
URN, SHA1 = "<urn:x-page:", "sha1:"
RECORDS_PER_FILE = 50_000
MIN_PAYLOAD = 0
DATE = "1970-01-01T00:00:00Z"
# Members are handed to the writer in blocks of about this size.
BLOCK_BYTES = 1 << 20
INFLATE_BYTES = 1 << 18
LEVEL = 6

# The digits of base 32 (RFC 4648), and an empty gzip member (RFC 1952).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")

_HEAD_END = b"\r\n\r\n"
_LENGTH = re.compile(rb"(?im)^Content-Length:[ \t]*(\d+)[ \t]*\r?$")
_INDEX = "offset long, length long, record_type string, page_id string, record_id string, payload_digest string"
_RECORD = (
    "page_id string, record_id string, record_type string, url string, payload_digest string, "
    "payload_bytes long, refers_to string, payload binary, file string, offset long, length long"
)


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 160 bits are eight groups of four digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _line(value: Column) -> Column:
    """Line ends would end the header."""
    return F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _urn(page: Column) -> Column:
    return F.concat(F.lit(URN), _line(page), F.lit(">"))


def with_types(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``pages(id, url, payload)`` with ``size``, ``digest``, ``record_type`` and the id that a revisit refers to.

    Only digests that occur again are joined back, so a corpus without copies moves no payload.
    """
    sized = pages.withColumn("size", F.octet_length("payload").cast("long")).withColumn(
        "digest", sha1_base32(F.col("payload").cast("binary"))
    )
    again = (
        sized.where(F.col("size") >= min_payload)
        .groupBy("digest")
        .agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("digest", "keeper")
    )
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    return sized.join(again, "digest", "left").select(
        "id", "url", "payload", "size", "digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"),
    )


def record_text(date: str = DATE) -> Column:
    """A record without the two line ends that close it."""

    def header(name: str, value: Column) -> Column:  # nothing where the value is null
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    digest = F.concat(F.lit(SHA1), F.col("digest"))
    profile = F.when(
        F.col("record_type") == "revisit", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    )
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(RECORD_END),
    )
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(""))
    block = F.concat(http, body)
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.coalesce(_urn(F.col("id")), F.concat(F.lit("<urn:sha1:"), F.col("digest"), F.lit(">")))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", _line(F.col("url"))),
        header("WARC-Payload-Digest", digest),
        header("X-Page-Id", _line(F.col("id"))),
        header("X-Payload-Length", F.col("size").cast("string")),
        header("WARC-Refers-To", _urn(F.col("refers_to"))),
        header("WARC-Profile", profile),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(
    pages: DataFrame,
    location: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_payload: int = MIN_PAYLOAD,
    records_per_file: int = RECORDS_PER_FILE,
    date: str = DATE,
) -> None:
    """Write a record per page; each file below ``location`` is one gzip stream."""
    rows = pages.select(
        F.col(f"`{key}`").alias("id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).alias("payload"),
    )
    records = with_types(rows, min_payload).select(record_text(date).alias("value"))
    writer = records.write.mode("overwrite").option("compression", "gzip").option("lineSep", RECORD_END)
    writer.option("maxRecordsPerFile", records_per_file).text(location)


def inflated(content: bytes) -> Iterator[bytes]:
    """The plain bytes of a gzip file of one or many members, in pieces."""
    at, end = 0, len(content)
    while at < end:
        stream = zlib.decompressobj(wbits=31)
        while at < end and not stream.eof:
            part = content[at : at + INFLATE_BYTES]
            at += len(part)
            yield stream.decompress(part, INFLATE_BYTES)
            while stream.unconsumed_tail and not stream.eof:
                yield stream.decompress(stream.unconsumed_tail, INFLATE_BYTES)
        while not stream.eof and (more := stream.decompress(b"", INFLATE_BYTES)):
            yield more
        if not stream.eof:
            raise ValueError("the gzip stream is cut short")
        at -= len(stream.unused_data)


def cut_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records (their closing line ends included) of a stream of plain bytes."""
    held = bytearray()
    need = 0
    for piece in pieces:
        held += piece
        while len(held) >= need:
            head = held.find(_HEAD_END)
            if head < 0:
                break
            length = _LENGTH.search(held, 0, head + 2)
            if length is None:
                raise ValueError(f"a record without Content-Length: {bytes(held[:80])!r}")
            need = head + len(_HEAD_END) + int(length[1]) + len(_HEAD_END)
            if len(held) < need:
                break
            record = bytes(held[:need])
            if not record.endswith(_HEAD_END):
                raise ValueError(f"a record that does not end where its length says: {record[:80]!r}")
            yield record
            del held[:need]
            need = 0
    if held:
        raise ValueError(f"{len(held)} bytes after the last record")


def headers(record: bytes) -> tuple[dict[str, str], int]:
    """Header fields of a record by lower-case name, and where its block begins."""
    end = record.index(_HEAD_END)
    lines = record[:end].decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v.removeprefix(" ") for k, _, v in (line.partition(":") for line in lines)}, end + len(_HEAD_END)


def member(record: bytes) -> bytes:
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(record) + deflate.flush()


def _bare(value: str | None, before: str, after: str = "") -> str | None:
    return None if value is None else value.removeprefix(before).removesuffix(after)


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the archives below ``source`` as one gzip member a record, with an index of offsets."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(source).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offset = seq = 0
        block, lines = bytearray(), []

        def rows() -> pa.RecordBatch:
            nonlocal seq, offset
            offset += len(EMPTY_MEMBER)  # the writer puts one after the block
            index = member("".join(lines).encode())
            arrays = [["archives", "index"], [seq, seq], [bytes(block), index]]
            seq += 1
            block.clear()
            lines.clear()
            types = (pa.string(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types, strict=True)], ["kind", "seq", "value"])

        for batch in batches:
            for content in batch.column("content"):
                for record in cut_records(inflated(content.as_py())):
                    packed, (head, _) = member(record), headers(record)
                    fields = (
                        offset, len(packed), head.get("warc-type", ""), head.get("x-page-id", ""),
                        head.get("warc-record-id", ""), _bare(head.get("warc-payload-digest"), SHA1) or "",
                    )
                    lines.append("\t".join(map(str, fields)) + "\n")
                    block += packed
                    offset += len(packed)
                    if len(block) >= BLOCK_BYTES:
                        yield rows()
        if block:
            yield rows()

    members = files.mapInArrow(run, "kind string, seq long, value binary")
    ordered = members.sortWithinPartitions("kind", "seq").select("kind", F.col("value").cast("string").alias("value"))
    writer = ordered.write.mode("overwrite").partitionBy("kind").option("encoding", "ISO-8859-1")
    writer.option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(target)
    _name_files(spark, target)


def _name_files(spark: SparkSession, target: str) -> None:
    """Give the written files the endings that tell readers what they are."""
    fs, root, jvm = _fs_and_path(spark, target)
    path = jvm.org.apache.hadoop.fs.Path
    for kind, ending in (("archives", "warc.gz"), ("index", "cdx.gz")):
        fs.mkdirs(path(root, kind))
        written = path(root, f"kind={kind}")
        if not fs.exists(written):
            continue
        for status in fs.listStatus(written):
            number = re.match(r"part-\d+", status.getPath().getName())
            if number and not fs.rename(status.getPath(), path(root, f"{kind}/{number[0]}.{ending}")):
                raise OSError(f"could not move {status.getPath()}")
        fs.delete(written, True)


def read_index(spark: SparkSession, location: str) -> DataFrame:
    """The sidecar index: ``file, offset, length, record_type, page_id, record_id, payload_digest``."""
    lines = spark.read.schema("line string").text(f"{location}/index")
    names = [c.split()[0] for c in _INDEX.split(", ")]
    parts = F.split("line", "\t")
    cols = [parts[k].alias(c) if k > 1 else parts[k].cast("long").alias(c) for k, c in enumerate(names)]
    return lines.select(F.regexp_extract(F.col("_metadata.file_name"), r"^part-\d+", 0).alias("file"), *cols)


def _record_row(record: bytes, file: str, offset: int, length: int) -> dict:
    head, start = headers(record)
    block = record[start : len(record) - len(_HEAD_END)]
    payload = block[block.index(_HEAD_END) + len(_HEAD_END) :]
    size = head.get("x-payload-length")
    return {
        "page_id": head.get("x-page-id"),
        "record_id": head.get("warc-record-id"),
        "record_type": head.get("warc-type"),
        "url": head.get("warc-target-uri"),
        "payload_digest": _bare(head.get("warc-payload-digest"), SHA1),
        "payload_bytes": len(payload) if size is None else int(size),
        "refers_to": _bare(head.get("warc-refers-to"), URN, ">"),
        "payload": payload if head.get("warc-type") == "response" else None,
        "file": file,
        "offset": offset,
        "length": length,
    }


def _members(content: bytes) -> Iterator[tuple[bytes, int, int]]:
    """Every member that holds a record, with its offset and length."""
    at, end, view = 0, len(content), memoryview(content)
    while at < end:
        stream, begin, parts = zlib.decompressobj(wbits=31), at, []
        while at < end and not stream.eof:
            part = view[at : at + INFLATE_BYTES]
            at += len(part)
            parts.append(stream.decompress(part))
        if not stream.eof:
            raise ValueError("the last gzip member is cut short")
        at -= len(stream.unused_data)
        record = b"".join(parts)
        if record:
            yield record, begin, at - begin


def _archives(spark: SparkSession, location: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(f"{location}/archives")
    return files.select(F.regexp_extract("path", r"(part-\d+)\.warc\.gz$", 1).alias("file"), "content")


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["payload"] or b"") + 200
        if size >= BLOCK_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _RECORD.split(", ")])


def read_records(spark: SparkSession, location: str) -> DataFrame:
    """Every record of normalised archives: header fields, payload (null in a revisit), file, offset and length."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                    for record, offset, length in _members(content.as_py()):
                        yield _record_row(record, file, offset, length)

        yield from _batches(rows(), _arrow_schema())

    return _archives(spark, location).mapInArrow(run, _RECORD)


def lookup(spark: SparkSession, location: str, wanted: DataFrame) -> DataFrame:
    """The records that ``wanted(file, offset, length)``, rows of the index, name; no other member is inflated."""
    ship_package(spark)
    asked = wanted.select(F.col("file").alias("of"), "offset", "length")

    def run(archive: pa.Table, places: pa.Table) -> pa.Table:
        def rows() -> Iterator[dict]:
            if len(archive) and len(places):
                content, file = archive.column("content")[0].as_py(), archive.column("file")[0].as_py()
                for place in places.sort_by("offset").to_pylist():
                    part = content[place["offset"] : place["offset"] + place["length"]]
                    yield _record_row(zlib.decompress(part, wbits=31), file, place["offset"], place["length"])

        return pa.Table.from_pylist(list(rows()), _arrow_schema())

    archives = _archives(spark, location).join(asked.select(F.col("of").alias("file")).distinct(), "file", "left_semi")
    return archives.groupBy("file").cogroup(asked.groupBy("of")).applyInArrow(run, _RECORD)


def op11_gzip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages: written as archives, normalised to one member a record, and read back."""
    area = stage_area(spark, "warc")
    whole, members = f"{area.area.root}/whole", f"{area.area.root}/members"
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), whole)
    normalise(spark, whole, members)
    return read_records(spark, members).select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def _base32_sql(digest: str) -> str:
    group = "('0x' || substr({d}, {at}, 5))::BIGINT"
    digits = [
        f"substr('{BASE32}', (({group.format(d=digest, at=1 + 5 * k)} >> {15 - 5 * j}) & 31)::INTEGER + 1, 1)"
        for k in range(8)
        for j in range(4)
    ]
    return " || ".join(digits)


OP11_SQL = f"""
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages
), kept AS (SELECT digest, max(page_id) AS keeper FROM sized GROUP BY digest)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_base32_sql("digest")} AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM sized JOIN kept USING (digest)
"""
