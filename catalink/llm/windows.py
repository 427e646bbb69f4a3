"""Repeated fixed-length strings over a whole corpus, found through content-anchored runs.

A *string* is ``length`` consecutive symbols (bytes or words) of one document.
Counting every string as a row of its own would shuffle many times the input,
so consecutive strings travel together:

* every string is anchored at the smallest of its first ``spread`` symbol
  grams (ties: the leftmost).  The anchor depends on the string's content
  alone, so equal strings have their anchor at the same place;
* consecutive strings with the same anchor form a *run*, about ``spread / 2``
  strings long, and one row: its *core* (the symbols right of the anchor that
  every string of the run holds) and its *whole* (all symbols of the run);
* a core that occurs once proves that no string of the run occurs elsewhere;
  a whole that occurs again proves that all of them do.  Only runs with a
  known core and a whole of their own are opened, first into *parts* of
  ``block`` strings, judged by an inner core and a whole of their own, and
  those that are still open into single strings.

Nothing is sampled: the strings of every run are decided, whole texts are
read, and a hot string meets only pre-aggregated counts and joins of two plain
shuffles, which adaptive execution splits.  Hashes have 64 bits, and a match
needs two of them (core and whole, or core and string).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import ship_package
from .staging import put, stage_area
from .text import Block, as_long, blocks, combine, mix, within, word_bounds, word_hashes

# Positions inside one slice must fit in the low bits of the sort key.
_BITS = 20
_LOW = np.uint64((1 << _BITS) - 1)
_HIGH = ~_LOW
_SLICE = 1 << 19

# Hashes of a gram, a core, a part's inner core and a string at every position of a slice, as far as they fit.
Hashes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Scheme:
    """``length`` symbols a string, anchors among the first ``spread`` grams (a power of two) of ``gram`` symbols."""

    length: int
    spread: int
    gram: int
    words: bool  # symbols are words, else bytes
    hashes: Callable[[np.ndarray, Scheme], Hashes]

    @property
    def core(self) -> int:
        return self.length - self.spread + 1

    @property
    def block(self) -> int:
        """Strings of a part: about the root of a run's."""
        return 1 << (self.spread.bit_length() // 2)

    @property
    def inner(self) -> int:
        return self.length - self.block + 1

    def symbols(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Hashed symbols of a block and the documents' offsets among them."""
        if self.words:
            hashes, _, _, first = word_hashes(block)
            return hashes, first
        return mix(block.data.astype(np.uint64) + np.uint64(1)), block.off


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` (a power of two) consecutive values."""
    size = 1
    while size < width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x


def _slices(sym: np.ndarray, off: np.ndarray, s: Scheme) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(begin, symbols, starts)``: slices with the positions in them at which a string starts."""
    total = len(sym)
    ok = np.zeros(total + 1, np.int64)
    sizes = np.diff(off)
    has = sizes >= s.length
    np.add.at(ok, off[:-1][has], 1)
    np.add.at(ok, off[1:][has] - s.length + 1, -1)
    ok = np.cumsum(ok[:-1]) > 0
    for begin in range(0, total, _SLICE):
        starts = np.flatnonzero(ok[begin : begin + _SLICE])
        if len(starts):
            yield begin, sym[begin : begin + _SLICE + s.length + s.spread], starts


def block_runs(sym: np.ndarray, off: np.ndarray, s: Scheme) -> tuple[np.ndarray, ...]:
    """``first, last, anchor, core, whole`` of every run of a block, positions within the block."""
    parts = []
    for begin, part, starts in _slices(sym, off, s):
        gram, core, _, string = s.hashes(part, s)
        key = (gram & _HIGH) | np.arange(len(gram), dtype=np.uint64)
        anchor = (sliding_min(key, s.spread)[starts] & _LOW).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(starts) != 1) | (np.diff(anchor) != 0)
        first = starts[new]
        last = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
        at = anchor[new]
        shape = ((last - first) * s.spread + (at - first)).astype(np.uint64)
        whole = combine(combine(string[first], string[last]), shape)
        parts.append((first + begin, last + begin, at + begin, core[at], whole))
    if not parts:
        zero = np.zeros(0, np.int64)
        return zero, zero, zero, zero.astype(np.uint64), zero.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def string_hashes(sym: np.ndarray, s: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the inner core and of the string at every position of a block (garbage where none fits)."""
    inner, string = np.zeros(len(sym), np.uint64), np.zeros(len(sym), np.uint64)
    for begin in range(0, len(sym), _SLICE):
        hashed = s.hashes(sym[begin : begin + _SLICE + s.length + s.spread], s)
        for out, part in ((inner, hashed[2][:_SLICE]), (string, hashed[3][:_SLICE])):
            out[begin : begin + len(part)] = part
    return inner, string


def _run_rows(s: Scheme):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            sym, off = s.symbols(block)
            first, last, anchor, core, whole = block_runs(sym, off, s)
            if len(first) == 0:
                continue
            doc = np.searchsorted(off, first, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.column("id")[doc]),
                    pa.array(block.column("tag")[doc]),
                    pa.array((first - off[doc]).astype(np.int32)),
                    pa.array((last - first).astype(np.int16)),
                    pa.array((anchor - first).astype(np.int16)),
                    pa.array(as_long(core)),
                    pa.array(as_long(whole)),
                ],
                names=["id", "tag", "first", "more", "lead", "core", "whole"],
            )

    return rows


def _part_rows(s: Scheme):
    """The parts of the runs listed with each document.

    A string is named by its distance ``d`` from the anchor; part ``k`` of a
    run holds the distances from ``k * block`` on, as far as the run has them.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            sym, off = s.symbols(block)
            inner, string = string_hashes(sym, s)
            lists = block.arrow("runs")
            n = lists.value_lengths().fill_null(0).to_numpy()
            runs = lists.flatten()
            col = lambda k: runs.field(k).to_numpy()  # noqa: B023, E731
            far = col("lead").astype(np.int64)
            near = far - col("more")
            anchor = np.repeat(off[:-1], n) + col("first") + far
            if np.any(anchor - near + s.length > np.repeat(off[1:], n)):
                raise ValueError("a run reaches beyond its text: two texts of one id share a 64-bit digest")
            pieces = far // s.block - near // s.block + 1
            many = lambda x: np.repeat(x, pieces)  # noqa: B023, E731
            k = many(near // s.block) + within(pieces)
            low = np.maximum(many(near), k * s.block)
            high = np.minimum(many(far), k * s.block + s.block - 1)
            anchor = many(anchor)
            shape = (low * s.spread + high).astype(np.uint64)
            size = high - low + 1
            each = np.repeat(anchor - low, size) - within(size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(many(col("core"))),
                    pa.array(as_long(combine(inner[anchor - k * s.block], k.astype(np.uint64)))),
                    pa.array(as_long(combine(combine(string[anchor - high], string[anchor - low]), shape))),
                    pa.array(many(col("whole"))),
                    pa.array(many(np.repeat(block.column("id"), n))),
                    pa.array(low.astype(np.int16)),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(as_long(string[each]))
                    ),
                ],
                names=["core", "inner", "part", "whole", "id", "low", "strings"],
            )

    return rows


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row, id, tag, text``: every column of the input packed in ``row``.

    ``(id, tag)`` tells texts apart even where an id repeats (``tag`` is a
    64-bit digest of the text); a null id counts as the smallest.
    """
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tag"),
        F.col(text).alias("text"),
    )


def repeated_starts(docs: DataFrame, s: Scheme, ordered: bool, label: str) -> DataFrame:
    """``id, tag, starts``: intervals ``[first, last]`` of string starts that count as repeated.

    ``docs`` has ``id, tag, text``.  With ``ordered`` a string counts if it
    also starts in a document with a smaller id, else if it starts anywhere
    else at all.
    """
    ship_package(docs.sparkSession)
    area = stage_area(docs.sparkSession, label)
    texts = docs.select("id", "tag", "text")
    columns = "id long, tag long, first int, more short, lead short, core long, whole long"
    runs = put(area, texts.mapInArrow(_run_rows(s), columns), "runs")

    def open_groups(classes: DataFrame, group: list[str], name: str) -> DataFrame:
        """Groups with a class that its own size or smallest id does not settle, but another class may."""
        held = classes.groupBy(*group)
        if ordered:
            found = held.agg(F.min("lowest").alias("a"), F.max("lowest").alias("b")).filter("a < b")
        else:
            found = held.agg(F.count(F.lit(1)).alias("a"), F.min("n").alias("b")).filter("a > 1 AND b = 1")
        return put(area, found.select(*group), name)

    # Round 1: cores that occur once leave, with all their strings.
    cores = put(area, runs.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core"), "cores")
    live = put(area, runs.join(cores, "core", "left_semi"), "live-runs")
    area.drop("runs", "cores")

    # Round 2: equal wholes are one class, settled by its size or its smallest id.
    where = F.struct("id", "tag", "first", "more", "lead")
    classes = live.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("at"))
    classes = put(area, classes.select("*", F.col("at.id").alias("lowest")), "classes")
    opened = classes.join(open_groups(classes, ["core"], "open-cores"), "core", "left_semi")

    # Round 3: parts of one run per open class, again settled by size or smallest id.
    listed = F.collect_list(F.struct("core", "whole", "at.first", "at.more", "at.lead")).alias("runs")
    per_doc = opened.groupBy(F.col("at.id").alias("id"), F.col("at.tag").alias("tag")).agg(listed)
    columns = "core long, inner long, part long, whole long, id long, low short, strings array<bigint>"
    parts = put(area, texts.join(per_doc, ["id", "tag"]).mapInArrow(_part_rows(s), columns), "parts")
    area.drop("open-cores")
    same = parts.groupBy("core", "inner", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "whole")).alias("at")
    )
    same = put(area, same.select("*", F.col("at.id").alias("lowest")), "part-classes")
    open_inner = open_groups(same, ["core", "inner"], "open-inner-cores")

    # Round 4: single strings of one part per class that is still open.
    chosen = same.join(open_inner, ["core", "inner"], "left_semi").select("core", "inner", "part", F.col("at.whole").alias("whole"))
    chosen = put(area, chosen, "open-parts")
    strings = (
        parts.join(chosen, ["core", "inner", "part", "whole"])
        .select("core", "inner", "part", "id", "low", F.posexplode("strings").alias("pos", "string"))
        .select("core", "inner", "part", "id", (F.col("low") + F.col("pos")).cast("short").alias("d"), "string")
    )
    strings = put(area, strings, "strings")
    met = strings.groupBy("core", "string")
    if ordered:
        known = met.agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("core", "string", "a")
    else:
        known = met.agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a <> b").select("core", "string", "a")
    known = put(area, known, "known-strings")
    singles = strings.join(known, ["core", "string"]).filter("id > a" if ordered else "true")
    singles = singles.groupBy("core", "inner", "part").agg(F.collect_set("d").alias("ds"))
    judged = same.select("core", "inner", "part", "n", "lowest").join(singles, ["core", "inner", "part"], "left")
    judged = put(area, judged.filter("n > 1 OR ds IS NOT NULL"), "part-verdicts")
    area.drop("part-classes", "open-inner-cores", "open-parts", "strings", "known-strings")

    # Back to the parts of every class, then to the runs of every class, then to the documents.
    all_of_it = F.col("id") > F.col("lowest") if ordered else F.col("n") > 1
    every = F.expr("transform(sequence(0, size - 1), i -> CAST(low + i AS SMALLINT))")
    distances = (
        parts.select("core", "inner", "part", "whole", "id", "low", F.size("strings").alias("size"))
        .join(judged, ["core", "inner", "part"])
        .select("core", "whole", F.when(all_of_it, every).otherwise(F.col("ds")).alias("ds"))
        .filter("ds IS NOT NULL")
    )
    distances = distances.groupBy("core", "whole").agg(F.flatten(F.collect_list("ds")).alias("ds"))
    verdicts = put(
        area, classes.select("core", "whole", "n", "lowest").join(distances, ["core", "whole"], "left"), "verdicts"
    )
    area.drop("classes", "parts", "part-verdicts")

    decided = live.join(verdicts.filter("n > 1 OR ds IS NOT NULL"), ["core", "whole"])
    run = F.array(F.struct("first", (F.col("first") + F.col("more")).cast("int").alias("last")))
    single = F.expr("transform(ds, d -> named_struct('first', first + lead - d, 'last', first + lead - d))")
    found = decided.select("id", "tag", F.when(all_of_it, run).otherwise(single).alias("starts")).filter("starts IS NOT NULL")
    # Equal rows bring the same starts; a set holds them once, and partial sets move.
    return found.groupBy("id", "tag").agg(F.flatten(F.collect_set("starts")).alias("starts"))


def _cut_rows(s: Scheme, as_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            if s.words:
                begin, end, off = word_bounds(block)
            else:
                off = block.off
            total = int(off[-1])
            lists = block.arrow("starts")
            doc = np.repeat(np.arange(block.rows), lists.value_lengths().fill_null(0).to_numpy())
            flat = lists.flatten()
            depth = np.zeros(total + 1, np.int64)
            if len(flat):
                if np.any(off[doc] + flat.field("last").to_numpy() + s.length > off[doc + 1]):
                    raise ValueError("a removed string reaches beyond its text: two texts of one id share a 64-bit digest")
                np.add.at(depth, off[doc] + flat.field("first").to_numpy(), 1)
                np.add.at(depth, off[doc] + flat.field("last").to_numpy() + s.length, -1)
            gone = np.cumsum(depth[:-1]) > 0
            left = np.concatenate(([0], np.cumsum(~gone)))
            # maximal removed runs; a run ends with its document
            opens, closes = gone.copy(), gone.copy()
            opens[1:] &= ~gone[:-1]
            closes[:-1] &= ~gone[1:]
            heads = off[:-1][np.diff(off) > 0]
            opens[heads] = gone[heads]
            tails = off[1:][np.diff(off) > 0] - 1
            closes[tails] = gone[tails]
            a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
            owner = np.searchsorted(off, a, side="right") - 1
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(block.rows + 1)).astype(np.int32)),
                pa.StructArray.from_arrays(
                    [pa.array((a - off[owner]).astype(np.int32)), pa.array((b - off[owner]).astype(np.int32))],
                    names=["first", "end"],
                ),
            )
            if s.words:
                begin, end = begin[~gone], end[~gone]
                size = end - begin + 1  # a word and the space after it
                out_off = np.concatenate(([0], np.cumsum(size)))
                out = np.full(int(out_off[-1]), 0x20, np.uint8)
                step = within(size)
                real = step < np.repeat(size - 1, size)
                out[real] = block.data[(np.repeat(begin, size) + step)[real]]
                bounds = out_off[left[off]]
                kept = [out[bounds[i] : max(bounds[i], bounds[i + 1] - 1)].tobytes() for i in range(block.rows)]
            else:
                rest, bounds = block.data[~gone], left[off]
                kept = [rest[bounds[i] : bounds[i + 1]].tobytes() for i in range(block.rows)]
            # A cut through a multi-byte character leaves a torn one, which a text cannot hold.
            out = pa.array([k.decode("utf-8", "ignore") for k in kept]) if as_text else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [block.arrow("row"), pa.array(np.diff(off).astype(np.int64)), spans, out],
                names=["row", "n_symbols", "spans", "kept"],
            )

    return cut


def cut_repeats(
    docs: DataFrame,
    s: Scheme,
    ordered: bool,
    label: str,
    key: str = "doc_id",
    text: str = "text",
    as_text: bool = False,
) -> DataFrame:
    """``row, n_symbols, spans, kept`` of every row: the packed input row, the number of its
    symbols, the maximal removed runs ``[first, end)`` in symbols, and what is left (words
    joined by one space, or the remaining bytes) as bytes or text."""
    rows = keyed(docs, key, text)
    starts = repeated_starts(rows, s, ordered, label)
    joined = rows.join(starts, ["id", "tag"], "left").select("row", "text", "starts")
    rest = T.StructType.fromDDL(
        f"n_symbols long, spans array<struct<first:int,end:int>>, kept {'string' if as_text else 'binary'}"
    )
    return joined.mapInArrow(_cut_rows(s, as_text), T.StructType([joined.schema["row"], *rest.fields]))


def removed_symbols() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["first"]).cast("long"))
