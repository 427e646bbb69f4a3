"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Diagonal run skipping: both token sequences of a text are arrays of byte ends.
At the current index shift the arrays are compared in blocks of doubling
length, so a stretch in which the tokens stand one to one is jumped in a few
comparisons; where the ends part, the tokens are walked one by one to the next
common end, which makes a group of its own and gives the new shift.

Corpus-wide, an id pair counts the documents that hold it linked.  Documents
are worked on in blocks of about 16 MB of text.  A block's distinct pairs (not
each document's) travel to the counts and back, so a pair that stands in every
document moves once a block; the documents' own links stay packed in the block.

Edge cases: null and empty texts, and texts that a tokenizer does not give back
byte for byte (the second one writes U+2581 for a space), have no tokens: zeros
and an empty digest.  Rows are aligned each, repeated or without an id; two
equal rows count twice.  An empty table gives an empty result.  Only id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import ship_package
from .staging import put, stage_area
from .text import within

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 16 << 20
# An id pair as one number: first id * PAIR + second id.
PAIR = 1 << 32

# Fixed value: how byte-level vocabularies cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Outside of these blocks characters are still being added.
_RARE = re.compile("[^\0-\u02af\u0300-\u0377\u0386-\u04ff\u2010-\u205f\u20a0-\u20b0\u2190-\u23f0\u3040-\u3096\u4e00-\u9fa5\uac00-\ud7a3]")
_SPACE = "▁"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes, in
    order, for the characters from U+0100.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class TokenPair:
    """Both tokenizers of a worker: token ids of texts, and every token's bytes.

    The first vocabulary's merges are numbered in their order (checked), so
    that tiktoken runs them, several times as fast; texts with characters that
    Unicode versions may class differently go to the tokenizer of the file.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = byte_of_char()
        with open(a_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranked = all(vocab[x + y] == 256 + k for k, (x, y) in enumerate(merges))
        self.a_bytes = [b""] * (1 + max(vocab.values()))
        for entry, i in vocab.items():
            # A special token's entry is no byte-level text, and no text yields it.
            self.a_bytes[i] = bytes(chars[c] for c in entry) if all(c in chars for c in entry) else entry.encode()
        ranks = {self.a_bytes[i]: i for i in range(256 + len(merges))}
        self.fast = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if ranked else None
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # Entry 2 * id stands inside of a group, the next one at its end.
        self.a_text = np.array([f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"], object)
        self.b_text = np.array([f"{i}{mark}" for i in range(len(self.b_bytes)) for mark in ",;"], object)

    def _a_ids(self, text: str) -> np.ndarray:
        if self.fast is None or not (text.isascii() or _RARE.search(text) is None):
            return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids by both tokenizers of every text with a space in front; empty where the bytes would differ."""
        none = np.zeros(0, np.int64)
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            raw = (" " + text).encode()
            # The first token twice, so that the getter always gives a tuple.
            if not text or not b or b"".join(itemgetter(b[0], *b)(self.b_bytes)[1:]) != raw:
                yield none, none
                continue
            a = self._a_ids(" " + text)
            # A byte-level vocabulary without a normaliser loses nothing; a token of another length would show here.
            yield (a, np.array(b, np.int64)) if self.a_len[a].sum() == len(raw) else (none, none)


@functools.lru_cache(maxsize=1)
def token_pair(a_path: str, b_path: str) -> TokenPair:
    return TokenPair(a_path, b_path)


def align(a_end: np.ndarray, b_end: np.ndarray):
    """Groups and links of two token sequences over the same bytes, given the tokens' byte ends.

    Returns ``(cuts, links)``.  ``cuts`` are three arrays ``a, b, n``: from
    tokens ``a`` and ``b`` on, ``n`` groups end one token further each.
    ``links`` are the index pairs of the groups that are not one to one.
    """
    x, y = a_end.tolist(), b_end.tolist()
    # Each closed by a mark of its own, so that no block matches beyond the end.
    raw_x, raw_y = np.append(a_end, -1).astype("<i4").tobytes(), np.append(b_end, -2).astype("<i4").tobytes()
    n = len(x)
    at_a, at_b, count, link_a, link_b = [], [], [], [], []
    i = j = 0
    while i < n:
        if x[i] == y[j]:
            at_a.append(i)
            at_b.append(j)
            p, q, w = 4 * i + 4, 4 * j + 4, 4
            while raw_x[p : p + w] == raw_y[q : q + w]:  # probe ever longer blocks at this shift
                p, q, w = p + w, q + w, 2 * w
            while w > 4:  # the run ends inside the last block
                w //= 2
                if raw_x[p : p + w] == raw_y[q : q + w]:
                    p, q = p + w, q + w
            count.append(p // 4 - i)
            i, j = p // 4, q // 4
        else:
            end_x, end_y = x[i], y[j]
            link_a.append(i)
            link_b.append(j)
            while end_x != end_y:
                if end_x < end_y:
                    i += 1
                    end_x = x[i]
                else:
                    j += 1
                    end_y = y[j]
                link_a.append(i)
                link_b.append(j)
            at_a.append(i)
            at_b.append(j)
            count.append(-1)  # a group that is not one to one ends here
            i += 1
            j += 1
    return tuple(np.array(c, np.int64) for c in (at_a, at_b, count)), (link_a, link_b)


def group_sizes(cuts) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of either sequence each group holds."""
    at_a, at_b, count = cuts
    times = np.abs(count)
    step = within(times)
    ends = (np.repeat(at_a, times) + step + 1, np.repeat(at_b, times) + step + 1)
    return np.diff(ends[0], prepend=0), np.diff(ends[1], prepend=0)


def all_links(cuts, links) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of all tokens whose byte ranges overlap."""
    at_a, at_b, count = cuts
    run = count > 0
    step = within(count[run])
    return tuple(
        np.concatenate((np.repeat(at[run], count[run]) + step, np.array(odd, np.int64)))
        for at, odd in ((at_a, links[0]), (at_b, links[1]))
    )


def groups_text(sizes: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray, pair: TokenPair) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of every group."""
    size_a, size_b = sizes
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    out = np.empty(len(a) + len(b), object)
    sides = ((a, pair.a_text, size_a, end_a, end_b - size_b), (b, pair.b_text, size_b, end_b, end_a))
    for ids, table, size, end, before in sides:
        entry = 2 * ids
        entry[end - 1] += 1
        out[np.arange(len(ids)) + np.repeat(before, size)] = table[entry]
    return "".join(out.tolist())[:-1]


def _texts(batch: pa.RecordBatch, at: int, size: int) -> list[str]:
    raw = batch.column("text").slice(at, size).to_pylist()
    return [t or "" for t in raw]


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, int]]:
    """Rows ``(first, number, bytes)`` of a batch with about ``size`` bytes of text; a longer text stands alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    first = total = 0
    for k, n in enumerate(lengths):
        if k > first and total + n > size:
            yield first, k - first, total
            first, total = k, 0
        total += n
    if len(lengths) > first:
        yield first, len(lengths) - first, total


def _read(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))


def _paths(tokenizers: tuple[str, str] | None) -> tuple[str, str]:
    return tokenizers or (public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))


def align_documents(
    df: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] | None = None
) -> DataFrame:
    """``id, a_ids, b_ids, a_sizes, b_sizes``: both token sequences and how many of each every group holds."""
    ship_package(df.sparkSession)
    paths, source = _paths(tokenizers), _read(df, key, text)
    ints = T.ArrayType(T.IntegerType())
    names = ("a_ids", "b_ids", "a_sizes", "b_sizes")
    schema = T.StructType([source.schema["id"], *(T.StructField(c, ints) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(*paths)
        for batch in batches:
            for at, size, _ in _slices(batch, 1 << 20):
                rows = []
                for a, b in pair.encode(_texts(batch, at, size)):
                    cuts, _ = align(np.cumsum(pair.a_len[a]), np.cumsum(pair.b_len[b]))
                    rows.append((a, b, *group_sizes(cuts)))
                lists = [pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in range(4)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, size), *lists], ["id", *names])

    return source.mapInArrow(run, schema)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK_LISTS = {"pairs": T.LongType(), "held": T.IntegerType(), "first": T.LongType()}


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values, "<i4").tobytes(), codec="zstd", asbytes=True)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    data = pa.decompress(raw, 4 * n, codec="zstd", asbytes=True) if n else b""
    return np.frombuffer(data, "<i4").astype(np.int64)


class _Block:
    """Documents gathered in a task: their numbers, and the id pairs that each holds linked."""

    def __init__(self):
        self.ids, self.numbers, self.digests, self.pairs, self.times, self.bytes = [], [], [], [], [], 0

    def row(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        size = np.array([len(p) for p in self.pairs], np.int64)
        flat = np.concatenate([*self.pairs, np.zeros(0, np.int64)])
        pairs, place = np.unique(flat, return_inverse=True)
        values = {
            "block": number,
            "ids": pa.concat_arrays(self.ids),
            **{c: [r[k] for r in self.numbers] for k, c in enumerate(_NUMBERS)},
            "digests": self.digests,
            "pairs": pairs,
            "held": np.bincount(place, minlength=len(pairs)),  # a document names each of its pairs once
            "first": np.concatenate(([0], np.cumsum(size))),
            "places": _pack(np.diff(place, prepend=0)),
            "times": _pack(np.concatenate([*self.times, np.zeros(0, np.int64)])),
        }
        arrays = []
        for field in schema:
            if pa.types.is_list(field.type):
                inner = values[field.name]
                inner = inner if isinstance(inner, pa.Array) else pa.array(inner, field.type.value_type)
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner))
            else:
                arrays.append(pa.array([values[field.name]], field.type))
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def aligned_blocks(df: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """``df(id, text)`` in blocks: per document its numbers and digest, its linked id pairs packed; the block's distinct pairs."""
    paths = _paths(tokenizers)
    of = lambda kind: T.ArrayType(kind)
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("ids", of(df.schema["id"].dataType))]
        + [T.StructField(c, of(T.LongType())) for c in _NUMBERS]
        + [T.StructField("digests", of(T.StringType()))]
        + [T.StructField(c, of(kind)) for c, kind in _BLOCK_LISTS.items()]
        + [T.StructField(c, T.BinaryType()) for c in ("places", "times")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        pair, out = token_pair(*paths), to_arrow_schema(schema)
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for at, size, total in _slices(batch, 1 << 20):
                block.ids.append(batch.column("id").slice(at, size))
                block.bytes += total
                for a, b in pair.encode(_texts(batch, at, size)):
                    cuts, links = align(np.cumsum(pair.a_len[a]), np.cumsum(pair.b_len[b]))
                    left, right = all_links(cuts, links)
                    pairs, times = np.unique(a[left] * PAIR + b[right], return_counts=True)
                    text = groups_text(group_sizes(cuts), a, b, pair)
                    block.numbers.append((len(a), len(b), len(a) + len(b) - len(left), len(left)))
                    block.digests.append(hashlib.sha256(text.encode()).hexdigest() if len(a) else "")
                    block.pairs.append(pairs)
                    block.times.append(times)
                if block.bytes >= BLOCK_BYTES:
                    yield block.row(number, out)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.row(number, out)

    return df.mapInArrow(run, schema)


def counted_pairs(blocks: DataFrame) -> DataFrame:
    """``pair, docs, best``: how many documents hold an id pair linked, and whether its first id has no commoner one."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).select("x.pairs", "x.held")
    counted = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("docs"))
    with_a = counted.withColumn("a", F.shiftright("pair", 32))
    most = with_a.groupBy("a").agg(F.max("docs").alias("most"))
    return with_a.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def id_map(pairs: DataFrame) -> DataFrame:
    """``a_id, b_id, docs, best`` of ``counted_pairs``: the translation table between the vocabularies."""
    a = F.shiftright("pair", 32)
    return pairs.select(a.alias("a_id"), (F.col("pair") - F.shiftleft(a, 32)).alias("b_id"), "docs", "best")


def alignment_summary(
    df: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] | None = None
) -> DataFrame:
    """Per document ``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    spark = df.sparkSession
    ship_package(spark)
    area = stage_area(spark, "alignment")
    blocks = put(area, aligned_blocks(_read(df, key, text), tokenizers), "blocks")
    pairs = put(area, counted_pairs(blocks), "pairs")
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    found = asked.join(pairs, "pair").select(F.col("block").alias("of"), "at", "docs", "best")
    longs = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = T.StructType(
        [T.StructField("id", df.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in longs]
        + [T.StructField("groups_sha256", T.StringType())]
    )

    def judge(block: pa.Table, counts: pa.Table) -> pa.Table:
        row = {c: block.column(c)[0] for c in block.column_names}
        values = {c: row[c].values for c in row if isinstance(row[c], pa.ListScalar)}
        first = values["first"].to_numpy()
        total = int(first[-1])
        docs, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), bool)
        at = counts.column("at").to_numpy()
        docs[at], best[at] = counts.column("docs").to_numpy(), counts.column("best").to_numpy()
        place = np.cumsum(_unpack(row["places"].as_py(), total))
        times = _unpack(row["times"].as_py(), total)
        running = lambda x: np.concatenate(([0], np.cumsum(x)))
        per_doc = lambda x: np.diff(running(x)[first])
        arrays = [values["ids"], *(values[c] for c in _NUMBERS)]
        arrays += [pa.array(per_doc(times * best[place])), pa.array(per_doc(times * docs[place])), values["digests"]]
        return pa.Table.from_arrays(arrays, names=["id", *longs, "groups_sha256"])

    grouped = blocks.drop("pairs", "held").groupBy("block").cogroup(found.groupBy("of"))
    return grouped.applyInArrow(judge, schema)


def op12_run_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: tokens by the byte-level and the piece tokenizer, their groups, links and corpus-wide counts."""
    rows = alignment_summary(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.withColumnRenamed("id", "doc_id")
