"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are token sequences: case-folded runs of Unicode
letters, marks and digits; whatever else there is (punctuation, symbols, spaces
of any kind) only parts them.  Case is folded as the upper case of the lower
case, so that sharp s meets its upper-case form SS.  Seeds are the items' grams of
``min_match`` tokens; documents and items that share seeds are paired.  For a
pair, the longest matches of tokens not yet marked are marked as tiles, again
and again, until none of ``min_match`` tokens is left; every round finds its
matches by running Karp-Rabin hashes over the unmarked tokens.  Tiles may lie
in any order, so a reordered passage is found as well.  A document is
contaminated by an item if the tiles cover at least ``min_coverage`` of the
item's tokens.

Documents are scanned where they lie and never shuffled.  The items go to the
tasks in blocks of about ``BLOCK_BYTES`` of benchmark text, one pass over the
documents for each block: a benchmark of any size is compared in full.

Edge cases: null or empty texts and items share nothing; an item of fewer than
``min_match`` tokens is matched as one seed of its own length; repeated items
and documents are reported each; an empty table gives an empty result; a null
id is reported as null; other columns are carried unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import ship_package
from .text import Block, Rolling, blocks, within, word_hashes

MIN_MATCH = 5
MIN_COVERAGE = 0.5
BLOCK_BYTES = 32 << 20

_FILTER_BITS = 20


def token_text(text: Column) -> Column:
    """The tokens of a text, cut by single spaces; documents and items go through it alike."""
    # the replacement stands between the two: directly nested, the optimizer drops the inner one
    return F.upper(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", " "))


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(item position, document position, length)`` of every tile.

    Each round takes the longest length at which unmarked runs of both sides
    still share a Karp-Rabin hash (found by bisection: sharing a longer string
    means sharing a shorter one), and marks all non-overlapping matches of it.
    """
    tiles: list[tuple[int, int, int]] = []
    free_a, free_b = np.ones(len(item), bool), np.ones(len(doc), bool)
    rolling_a, rolling_b = Rolling(item), Rolling(doc)

    def starts(free: np.ndarray, length: int) -> np.ndarray:
        if length > len(free):
            return np.zeros(0, np.int64)
        busy = np.concatenate(([0], np.cumsum(~free)))
        return np.flatnonzero(busy[length:] == busy[:-length])

    def shared(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = starts(free_a, length), starts(free_b, length)
        return a, rolling_a.ranges(a, a + length), b, rolling_b.ranges(b, b + length)

    top = min(len(item), len(doc))
    while top >= min_match:
        low, high = min_match - 1, top
        while low < high:
            mid = (low + high + 1) // 2
            _, ha, _, hb = shared(mid)
            if np.isin(ha, hb).any():
                low = mid
            else:
                high = mid - 1
        if low < min_match:
            break
        a, ha, b, hb = shared(low)
        order = np.argsort(hb, kind="stable")
        for i, h in zip(a, ha, strict=True):
            if not free_a[i : i + low].all():
                continue
            k = np.searchsorted(hb, h, sorter=order)
            while k < len(order) and hb[order[k]] == h:
                j = b[order[k]]
                if free_b[j : j + low].all():
                    tiles.append((int(i), int(j), low))
                    free_a[i : i + low] = False
                    free_b[j : j + low] = False
                    break
                k += 1
        top = low  # no longer match can appear any more
        if not free_a.any():
            break
    return tiles


class ItemIndex:
    """Seeds of a block of benchmark items (their ``token_text``)."""

    def __init__(self, items: list[tuple[object, str | None]], min_match: int):
        self.min_match = min_match
        self.ids = [i for i, _ in items]
        batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in items], pa.string())], names=["text"])
        tokens, first = [], [0]
        for block in blocks([batch], size=1 << 62):
            hashes, _, _, off = word_hashes(block)
            tokens.append(hashes)
            first.extend(off[1:].tolist())
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        self.first = np.array(first, np.int64)
        self.size = np.diff(self.first)
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        # items shorter than a seed are seeds of their own length
        lengths = np.minimum(self.size, min_match)
        rolling = Rolling(self.tokens)
        for length in np.unique(lengths[lengths > 0]).tolist():
            own = np.flatnonzero(lengths == length)
            n = self.size[own] - length + 1
            at = np.repeat(self.first[own], n) + within(n)
            hashes = rolling.ranges(at, at + length)
            order = np.argsort(hashes, kind="stable")
            maybe = np.zeros(1 << _FILTER_BITS, bool)
            maybe[(hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
            self.seeds[length] = (hashes[order], at[order], maybe)

    def hits(self, hashes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document row and item token position of every shared seed of a block."""
        docs, places = [], []
        rolling = Rolling(hashes)
        for length, (seeds, at, maybe) in self.seeds.items():
            windows = rolling.windows(length)
            found = np.flatnonzero(maybe[(windows & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
            lo = np.searchsorted(seeds, windows[found], side="left")
            n = np.searchsorted(seeds, windows[found], side="right") - lo
            doc = np.searchsorted(off, found, side="right") - 1
            n[found + length > off[doc + 1]] = 0  # a seed does not run on into the next document
            docs.append(np.repeat(doc, n))
            places.append(at[np.repeat(lo, n) + within(n)])
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(docs), np.concatenate(places)

    def scan(self, block: Block, min_coverage: float) -> Iterator[tuple[int, int, int, int, int]]:
        """``(row, item, covered tokens, tiles, longest tile)`` of every contaminated pair of a block."""
        hashes, _, _, off = word_hashes(block)
        doc, place = self.hits(hashes, off)
        if len(doc) == 0:
            return
        hit = np.unique(np.stack((doc, place), axis=1), axis=0)
        doc, place = hit[:, 0], hit[:, 1]
        item = np.searchsorted(self.first, place, side="right") - 1
        # item is ascending within a document, as places are
        new = np.flatnonzero(np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(item) != 0))))
        for a, b in zip(new, np.append(new[1:], len(doc)), strict=True):
            row, which = int(doc[a]), int(item[a])
            size = int(self.size[which])
            seed = min(size, self.min_match)
            # tiles lie inside the union of the seeds: no pair below the threshold here can reach it
            at = place[a:b]
            union = int(np.minimum(np.diff(np.append(at, at[-1] + seed)), seed).sum())
            if union < min_coverage * size:
                continue
            tokens = self.tokens[self.first[which] : self.first[which + 1]]
            tiles = tile(tokens, hashes[off[row] : off[row + 1]], seed)
            covered = sum(t[2] for t in tiles)
            if covered >= min_coverage * size and covered > 0:
                yield row, which, covered, len(tiles), max(t[2] for t in tiles)


def item_blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, str | None]]]:
    """The benchmark's ``token_text`` in blocks of about ``BLOCK_BYTES``, dealt by a hash of the row."""
    rows = benchmark.select(F.col(item).alias("item"), token_text(F.col(text)).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    blocks_needed = max(1, -(-total // BLOCK_BYTES))
    dealt = F.pmod(F.xxhash64("item", "text"), F.lit(blocks_needed))
    for k in range(blocks_needed):
        yield [(r["item"], r["text"]) for r in rows.filter(dealt == k).collect()]


def _pair_rows(index, min_coverage: float, kind: pa.DataType):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: ItemIndex = index.value
        for block in blocks(batches):
            pairs = list(found.scan(block, min_coverage))
            if not pairs:
                continue
            row, item, covered, tiles, longest = (np.array(c) for c in zip(*pairs, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    block.arrow("id").take(pa.array(row)),
                    pa.array([found.ids[i] for i in item], kind),
                    pa.array(found.size[item]),
                    pa.array(covered.astype(np.int64)),
                    pa.array(covered / found.size[item]),
                    pa.array(tiles.astype(np.int32)),
                    pa.array(longest.astype(np.int32)),
                ],
                names=["id", "item", "n_tokens", "covered", "coverage", "n_tiles", "longest"],
            )

    return rows


def contaminated_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``key, item, n_tokens, covered, coverage, n_tiles, longest`` of every contaminated pair."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(key).cast("long").alias("id"), token_text(F.col(text)).alias("text"))
    schema = "id long, item long, n_tokens long, covered long, coverage double, n_tiles int, longest int"
    out = None
    for items in item_blocks(benchmark.withColumn(item, F.col(item).cast("long")), item, item_text):
        index = spark.sparkContext.broadcast(ItemIndex(items, min_match))
        pairs = rows.mapInArrow(_pair_rows(index, min_coverage, pa.int64()), schema)
        out = pairs if out is None else out.union(pairs)
    return out.withColumnsRenamed({"id": key, "item": item})


def _clean_rows(index, min_coverage: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: ItemIndex = index.value
        for block in blocks(batches):
            keep = np.ones(block.rows, bool)
            for row, *_ in found.scan(block, min_coverage):
                keep[row] = False
            out = block.batch.slice(block.first, block.rows)
            yield out.select(["row", "text"]).filter(pa.array(keep))

    return rows


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, all columns unchanged; no shuffle."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.struct("*").alias("row"), token_text(F.col("text")).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    for items in item_blocks(benchmark, "item_id", "text"):
        index = spark.sparkContext.broadcast(ItemIndex(items, min_match))
        rows = rows.mapInArrow(_clean_rows(index, min_coverage), schema)
    return rows.select("row.*")


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: every contaminated pair with its coverage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contaminated_pairs(docs, benchmark)
