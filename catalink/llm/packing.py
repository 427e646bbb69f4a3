"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Bulk-synchronous best-fit: documents and gaps are sorted by size, and the
documents go in ranges of that order, the largest first.  In a step all
documents of one size sweep for their successors, the smallest gaps that hold
them; conflicts over the gaps of one size are resolved by rank: the lowest
ranks share the first gap, as many as it holds, the next ranks the next one.
Documents that find no gap open new sequences, the gaps are updated, and the
next size follows.  The result is that of best-fit decreasing.

Sizes are integers up to the capacity, so equal sizes are swept as runs: a
step works on at most ``capacity`` sizes of gaps, whatever the corpus, and
yields a plan of rank intervals.  The pieces themselves stay distributed:
Spark ranks them inside their size (in buckets, so that a size with a third of
all pieces is split) and each looks its place up in the plan.

Edge cases: a null or empty text is the one end token; a text longer than the
capacity is cut into full pieces and a rest; repeated rows are packed each;
ties in size are ranked by id and piece; an empty table gives an empty result;
only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shipping import ship_package
from .staging import put, stage_area
from .text import Block, Rolling, blocks, mix, within, word_bounds

CAPACITY = 2048
END_ID = 0
# Pieces of one size are ranked inside so many buckets.
RANK_BUCKETS = 64
# Pieces of words a worker remembers the ids of; beyond that it starts afresh.
CACHE_PIECES = 600_000

_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True
# ASCII punctuation but for the apostrophe, which opens contractions.
_PUNCT = np.array([33 <= b < 127 and not chr(b).isalnum() and b != ord("'") for b in range(256)])


def cut_words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two pieces of every word as byte ranges, the bytes to read them from, and the documents' word offsets.

    A word of letters (ASCII and U+00C0 to U+00FF) and then punctuation is cut
    between them and its letters are lower-cased, as the tokenizer does it; any
    other word is one piece, as it stands, and an empty one.
    """
    starts, ends, first = word_bounds(block)
    data = block.data
    # The two bytes of U+00C0 .. U+00FF, but for the multiplication and division signs.
    lead = data == 0xC3
    after = np.zeros(len(data), bool)
    after[1:] = lead[:-1]
    latin = after & (data != 0x97) & (data != 0xB7)
    letter = _LETTER[data] | latin
    letter[:-1] |= latin[1:]
    punct = _PUNCT[data]
    count = lambda marks: np.concatenate(([0], np.cumsum(marks)))
    letters, known = count(letter), count(letter | punct)
    back = np.zeros(len(data), bool)
    back[1:] = letter[1:] & punct[:-1]  # letters after punctuation
    turns = count(back)
    plain = letter[starts] if len(starts) else np.zeros(0, bool)
    plain &= (known[ends] - known[starts] == ends - starts) & (turns[ends] == turns[starts + 1])
    middle = np.where(plain, starts + letters[ends] - letters[starts], ends)
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, starts[plain], 1)
    np.add.at(inside, ends[plain], -1)
    upper = (_UPPER[data] | latin & (data <= 0x9E)) & (np.cumsum(inside[:-1]) > 0)
    folded = data + upper.astype(np.uint8) * np.uint8(0x20)
    pieces = np.stack((starts, middle, middle, ends), axis=1).reshape(-1, 2)
    return pieces, folded, starts, first


class PieceIds:
    """Token ids of pieces of words, remembered per worker.

    The tokenizer drops white space and never joins across it, so a text's ids
    are its pieces' ids in a row.  Pieces are known by a 64-bit hash.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.start, self.size, self.flat = array("q"), array("q"), array("I")

    def _tokenise(self, pieces: list[bytes]) -> None:
        """Append new pieces, joined by spaces in one call; offsets tell them apart."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        got = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        owner = np.searchsorted(begins, [a for a, _ in got.offsets], side="right") - 1
        cuts = np.searchsorted(owner, np.arange(len(pieces) + 1))
        self.start.extend((cuts[:-1] + len(self.flat)).tolist())
        self.size.extend(np.diff(cuts).tolist())
        self.flat.extend(got.ids)

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of the block, each closed by ``END_ID``, and the texts' offsets."""
        if len(self.known) > CACHE_PIECES:
            self.clear()
        pieces, data, _, first = cut_words(block)
        hashes = Rolling(mix(data.astype(np.uint64) + np.uint64(1))).ranges(pieces[:, 0], pieces[:, 1])
        uniq, where, each = np.unique(hashes, return_index=True, return_inverse=True)
        uniq = uniq.tolist()
        fresh = [k for k, h in enumerate(uniq) if h not in self.known]
        for at in range(0, len(fresh), 4096):
            part = fresh[at : at + 4096]
            count = len(self.start)
            ranges = pieces[where[part]].tolist()
            self._tokenise([data[a:b].tobytes() for a, b in ranges])
            self.known.update(zip((uniq[k] for k in part), range(count, count + len(part)), strict=True))
        index = np.array([self.known[h] for h in uniq], np.int64)[each]
        start, size = np.array(self.start, np.int64)[index], np.array(self.size, np.int64)[index]
        ends = np.concatenate(([0], np.cumsum(size)))[2 * first[1:]]  # ids up to the end of each text
        off = np.concatenate(([0], ends + np.arange(1, block.rows + 1)))
        out = np.full(int(off[-1]), END_ID, np.uint32)
        real = np.ones(len(out), bool)
        real[off[1:] - 1] = False
        out[real] = np.array(self.flat, np.uint32)[np.repeat(start, size) + within(size)]
        return out, off


_LOADED: dict[str, PieceIds] = {}


def _piece_ids(path: str) -> PieceIds:
    if path not in _LOADED:
        _LOADED[path] = PieceIds(path)
    return _LOADED[path]


def _piece_rows(vocabulary: str, capacity: int, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _piece_ids(public_tokenizers.path(vocabulary))
        for block in blocks(batches):
            ids, off = known.encode(block)
            size = np.diff(off)
            n = -(-size // capacity)
            piece = within(n)
            start = piece * capacity
            length = np.minimum(capacity, np.repeat(size, n) - start)
            begin = np.repeat(off[:-1], n) + start
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a : a + k]) for a, k in zip(begin, length, strict=True)]
            columns = [
                block.arrow("id").take(pa.array(np.repeat(np.arange(block.rows), n))),
                pa.array(piece.astype(np.int32)),
                pa.array(start),
                pa.array(length),
                pa.array(crc, pa.int64()),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cuts = np.append(begin, len(ids)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def tokenise(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    capacity: int = CAPACITY,
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``id, piece, start, length, ids_crc32[, ids]`` of every piece of every document."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(_piece_rows(vocabulary, capacity, with_ids), schema)


@dataclass
class Plan:
    """Rank intervals ``[rank, rank + count)`` of a size, their first sequence and their offset in it."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def sweep_plan(counts: dict[int, int], capacity: int) -> Plan:
    """Bulk-synchronous best-fit over runs of equal sizes (see the module's text)."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap size -> runs of sequences (first, count)
    sizes: list[int] = []  # the gap sizes, ascending
    rows: list[tuple[int, int, int, int]] = []
    opened = 0

    for size in sorted((k for k, n in counts.items() if n > 0), reverse=True):
        left, rank = counts[size], 0
        updates: list[tuple[int, int, int]] = []

        def fill(gap: int, first: int, count: int) -> int:
            """Documents go by rank to ``count`` gaps, as many as a gap holds to each; the number of gaps used."""
            nonlocal left, rank
            each, used = gap // size, 0
            for per, many in ((each, min(count, left // each)), (left % each, 1)):
                if per and many and used + many <= count and per * many <= left:
                    for j in range(per):
                        rows.append((size, rank, first + used, capacity - gap + j * size))
                        rank += many
                    left -= per * many
                    updates.append((gap - per * size, first + used, many))
                    used += many
            return used

        at = bisect_left(sizes, size)  # the successor: the smallest gap that holds this size
        while left and at < len(sizes):
            gap = sizes[at]
            runs = gaps[gap]
            while runs and left:
                first, count = runs.pop()
                used = fill(gap, first, count)
                if used < count:
                    runs.append((first + used, count - used))
            if not runs:
                del gaps[gap], sizes[at]
        if left:
            opened += fill(capacity, opened, left)
        for gap, first, many in updates:
            if gap:
                if gap not in gaps:
                    gaps[gap] = []
                    insort(sizes, gap)
                gaps[gap].append((first, many))
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan(*table.T)


def _place_rows(plan, capacity: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        # sizes and ranks in one ascending key: ranks stay below 2^50
        keys = (p.length << np.int64(50)) + p.rank
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << np.int64(50)) + rank, side="right") - 1
            sequence, offset = p.sequence[at] + rank - p.rank[at], p.offset[at]
            names = [*batch.schema.names, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], names=names)

    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces(id, piece, length, ...)`` with ``sequence_id`` and ``offset``; ``pieces`` should be a written table."""
    ship_package(pieces.sparkSession)
    sized = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(RANK_BUCKETS)).cast("int"))
    counts = sized.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    area = stage_area(pieces.sparkSession, "packing-plan")
    counts = put(area, counts, "counts")
    # At most ``capacity`` rows, whatever the corpus.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(sweep_plan(totals, capacity))

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32")
    ranked = sized.withColumn("row", F.row_number().over(inside))
    # At most capacity * RANK_BUCKETS rows, hence the broadcast.
    ranked = ranked.join(F.broadcast(offsets), ["length", "bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("before") + F.col("row") - 1).alias("rank"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    placed = ranked.mapInArrow(_place_rows(plan, capacity), f"{kinds}, sequence_id long, offset long")
    return placed.select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place: ``id, piece, start, length, ids_crc32, sequence_id, offset``."""
    area = stage_area(docs.sparkSession, "packing")
    return pack(put(area, tokenise(docs, capacity=capacity), "pieces"), capacity)


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the packed token sequences themselves."""
    area = stage_area(docs.sparkSession, "packed")
    placed = pack(put(area, tokenise(docs, capacity=capacity, with_ids=True), "pieces"), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "id", "ids")))  # at most ``capacity`` ids
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.id").alias("doc_ids")
    )


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of at most 2048 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs).withColumnRenamed("id", "doc_id")
