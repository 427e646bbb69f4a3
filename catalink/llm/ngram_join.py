"""N-gram Jaccard self-join by vertical partitioning.

All distinct word n-grams stand in one global order, rare ones first: n-grams
that a mergeable heavy-hitter summary of the whole corpus names come last, by
size class; inside a class the hash decides.  The order is cut in fragments,
and the overlap of a pair is the sum of its partial overlaps:

* the *front* fragment of a document is its first ``|x| - ceil(t |x|) + 1``
  n-grams: sets with similarity ``t`` share one there.  A pair is met at an
  n-gram only if what follows it in both orders can still reach the overlap
  the pair needs, and its partial overlap in front is counted before any other;
* pairs that the front overlap leaves open have their partial overlaps counted
  in each of ``FRAGMENTS`` hash fragments, separately, and summed.

Documents with equal sets are one node, so copies never meet as pairs.  Large
groups of near copies are linked first to one node of each n-gram's postings,
the one in whose order the n-gram comes earliest (in a group, the one with the
fewest edits): a star, linear in the postings.  After that only nodes that are
not yet connected meet, which loses no component: a link inside a component
changes nothing.  ``similarity_join`` gives the links themselves: there all pairs
of classes are counted.

Edge cases: null texts and texts without a word have no n-grams and link with
nothing; with fewer than ``n`` words the whole sequence is the one n-gram;
repeated rows and ties get the same component.  Components are built over the
sets, never over ids: rows that share an id, or have none, are linked only if
their texts are.  A component is named by its smallest id, a null id counting
as the smallest, so two components can bear one name where an id is repeated;
``keep_one_per_component`` tells them apart.  An empty table gives an empty
result; only id and text are read.  Sets are told apart by 64-bit keys, n-grams
by 64-bit hashes, the texts of one id by 64-bit digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import components
from .shipping import ship_package
from .staging import Tables, put, stage_area
from .text import LOWER_AZ, Block, Rolling, as_long, blocks, combine, mix, within, word_hashes

WORDS = 5
THRESHOLD_PERCENT = 75
FRAGMENTS = 4
# The heavy-hitter summary: entries a task keeps, the least corpus count that is heavy,
# entries sent to the tasks.
SUMMARY_TASK = 1 << 17
SUMMARY_HELD = 1 << 21  # n-grams of a task that are counted together
HEAVY_COUNT = 16
HEAVY_MAX = 1 << 17
# Stands for a null id.
LOWEST = -(1 << 63)


def block_shingles(block: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every document of the block, sorted in it, and their offsets."""
    hashes, _, _, first = word_hashes(block, fold=LOWER_AZ)
    counts = np.diff(first)
    rolling = Rolling(hashes)
    size = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(block.rows), size)
    start = np.repeat(first[:-1], size) + within(size)
    end = np.minimum(start + n, first[1:][doc])
    grams = rolling.ranges(start, end)
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[keep], doc[keep]
    return grams, np.searchsorted(doc, np.arange(block.rows + 1))


def set_keys(grams: np.ndarray, off: np.ndarray) -> np.ndarray:
    """64-bit key of every document's set: a sum over its n-grams, so that the order does not matter."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)))))
    sums = total[off[1:]] - total[off[:-1]]
    return combine(sums, np.diff(off).astype(np.uint64))


def front_size(size: np.ndarray, percent: int) -> np.ndarray:
    return np.where(size > 0, size - (size * percent + 99) // 100 + 1, 0)


def _merge(a: tuple[np.ndarray, np.ndarray], keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate((a[0], keys)), np.concatenate((a[1], counts))
    uniq, inverse = np.unique(keys, return_inverse=True)
    sums = np.bincount(inverse, weights=counts, minlength=len(uniq)).astype(np.int64)
    if len(uniq) > SUMMARY_TASK:
        top = np.argpartition(sums, -SUMMARY_TASK)[-SUMMARY_TASK:]
        uniq, sums = uniq[top], sums[top]
    return uniq, sums


def _survey_rows(n: int):
    """One row per document (its set key and size), and at the end the task's frequent n-grams."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "digest", "node", "size", "heavy"]
        summary = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        held: list[np.ndarray] = []

        def settle() -> None:
            nonlocal summary
            if held:
                uniq, counts = np.unique(np.concatenate(held), return_counts=True)
                summary = _merge(summary, uniq[counts > 1], counts[counts > 1])
                held.clear()

        for block in blocks(batches):
            grams, off = block_shingles(block, n)
            size = np.diff(off)
            yield pa.RecordBatch.from_arrays(
                [
                    block.arrow("id"),
                    block.arrow("digest"),
                    pa.array(as_long(set_keys(grams, off))),
                    pa.array(size.astype(np.int32)),
                    pa.array(np.zeros(len(size), bool)),
                ],
                names=names,
            )
            held.append(grams)
            if sum(map(len, held)) > SUMMARY_HELD:
                settle()
        settle()
        # id holds the n-gram here and node its count
        if len(summary[0]):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(as_long(summary[0])),
                    pa.array(np.zeros(len(summary[0]), np.int64)),
                    pa.array(summary[1]),
                    pa.array(np.zeros(len(summary[0]), np.int32)),
                    pa.array(np.ones(len(summary[0]), bool)),
                ],
                names=names,
            )

    return rows


def _front_rows(n: int, percent: int, heavy, classes):
    """``gram, node, size, pos, heavy``: the front fragment of every document's set in the global order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, level = heavy.value, classes.value
        for block in blocks(batches):
            grams, off = block_shingles(block, n)
            size = np.diff(off)
            if len(grams) == 0:
                continue
            rank = np.zeros(len(grams), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                rank = np.where(known[at] == grams, level[at], 0)
            doc = np.repeat(np.arange(block.rows), size)
            order = np.lexsort((grams, rank, doc))
            place = within(size)
            front = np.repeat(front_size(size, percent), size) > place
            pick = order[front]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(as_long(grams[pick])),
                    pa.array(as_long(set_keys(grams, off))[doc[pick]]),
                    pa.array(size[doc[pick]].astype(np.int32)),
                    pa.array(place[front].astype(np.int32)),
                    pa.array(rank[pick] > 0),
                ],
                names=["gram", "node", "size", "pos", "heavy"],
            )

    return rows


def _fragment_rows(n: int, fragments: int):
    """``node, fragment, grams``: a set cut by n-gram hash, one row per fragment."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            grams, off = block_shingles(block, n)
            asked = as_long(set_keys(grams, off)) == block.column("node")
            # grams are sorted as unsigned hashes: a fragment is a range of them
            edges = np.array([(k << 64) // fragments for k in range(1, fragments)], dtype=np.uint64)
            part = np.searchsorted(edges, grams, side="right")
            doc = np.repeat(np.arange(block.rows), np.diff(off))
            cuts = np.searchsorted(doc * fragments + part, np.arange(block.rows * fragments + 1))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(block.column("node"), fragments)),
                    pa.array(np.tile(np.arange(fragments, dtype=np.int32), block.rows)),
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(as_long(grams))),
                ],
                names=["node", "fragment", "grams"],
            )
            yield out.filter(pa.array(np.repeat(asked, fragments)))

    return rows


def _required(x: str, y: str, percent: int) -> str:
    """Least overlap of sets of these sizes that link: 100 i >= p (x + y - i)."""
    return f"(({percent} * ({x} + {y}) + {99 + percent}) div {100 + percent})"


def _front(size: str, percent: int) -> str:
    return f"({size} - (({size} * {percent} + 99) div 100) + 1)"


def _keyed(key: str, text: str) -> tuple[Column, Column]:
    """A row's id, the smallest long for a null one, and the digest of its text."""
    return F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)).alias("id"), F.xxhash64(F.col(text)).alias("digest")


def similarity_components(
    docs: DataFrame, n: int = WORDS, percent: int = THRESHOLD_PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_shingles, component_id`` of every row of ``docs``."""
    members, named = _named_nodes(docs, n, percent, key, text)
    undo = lambda c: F.when(c == LOWEST, F.lit(None).cast("long")).otherwise(c)
    empty = members.filter("size = 0").select("id", "size", F.col("id").alias("component_id"))
    full = members.filter("size > 0").join(named.select("node", "component_id"), "node").select("id", "size", "component_id")
    return full.union(empty).select(
        undo(F.col("id")).alias(key), F.col("size").cast("long").alias("n_shingles"), undo(F.col("component_id")).alias("component_id")
    )


def _named_nodes(docs: DataFrame, n: int, percent: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows' sets, ``id, digest, node, size``, and of every set the first row of its component.

    The latter is ``node, rep, digest, component_id, component_digest``: the smallest
    (id, digest) of the set's rows and that of the component's.
    """
    area, texts, members, front = _fronts(docs, n, percent, key, text)
    return members, _joined(area, texts, members, front, n, percent)


def _fronts(docs: DataFrame, n: int, percent: int, key: str, text: str) -> tuple[Tables, DataFrame, DataFrame, DataFrame]:
    """The step tables, the texts, the rows' sets and the front fragments of all sets."""
    spark = docs.sparkSession
    ship_package(spark)
    area = stage_area(spark, "ngram-join")
    texts = docs.select(*_keyed(key, text), F.col(text).alias("text"))

    survey = put(area, texts.mapInArrow(_survey_rows(n), "id long, digest long, node long, size int, heavy boolean"), "survey")
    members = survey.filter("not heavy").select("id", "digest", "node", "size")
    frequent = (
        survey.filter("heavy")
        .groupBy("id")
        .agg(F.sum("node").alias("n"))
        .filter(F.col("n") >= HEAVY_COUNT)
        .orderBy(F.desc("n"), "id")
        .limit(HEAVY_MAX)
        .toPandas()  # at most HEAVY_MAX rows: only the order of n-grams depends on it, never the result
    )
    grams = frequent["id"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    level = np.floor(np.log2(np.maximum(frequent["n"].to_numpy(np.float64), 1))).astype(np.int64)
    heavy = spark.sparkContext.broadcast(grams[order])
    classes = spark.sparkContext.broadcast(level[order])

    front = texts.mapInArrow(
        _front_rows(n, percent, heavy, classes), "gram long, node long, size int, pos int, heavy boolean"
    )
    return area, texts, members, front


def _postings(area: Tables, members: DataFrame, front: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each set, and the front postings of n-grams that two or more sets hold in front."""
    firsts = members.filter("size > 0").groupBy("node").agg(
        F.min(F.struct("id", "digest")).alias("r"), F.first("size").alias("size")
    )
    nodes = put(area, firsts.select("node", F.col("r.id").alias("rep"), F.col("r.digest").alias("digest"), "size"), "nodes")
    # Heavy n-grams are known to be shared.
    columns = ["gram", "node", "size", "pos"]
    group = Window.partitionBy("gram")
    light = front.filter("not heavy").select(*columns)
    shared = light.withColumn("lo", F.min("node").over(group)).withColumn("hi", F.max("node").over(group)).filter("lo <> hi")
    common = front.filter("heavy").select(*columns)
    return nodes, put(area, shared.select(*columns).union(common).distinct(), "postings")


def _joined(area: Tables, texts: DataFrame, members: DataFrame, front: DataFrame, n: int, percent: int) -> DataFrame:
    """From the sets' nodes and the front postings to the nodes' components, named by their first rows."""
    nodes, postings = _postings(area, members, front)
    columns = ["gram", "node", "size", "pos"]

    # Stars: every node with the hub of each of its n-grams; the best partner of a node is verified.
    hubs = put(area, _hubs(postings), "hubs")
    arms = (
        postings.join(hubs, "gram")
        .filter("node <> hub")
        .filter(_can_meet("size", "pos", "hub_size", "hub_pos", percent))
        .groupBy("node", "hub")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    best = arms.groupBy("node").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
    first_pairs = put(area, best.select(F.least("node", "hub").alias("x"), F.greatest("node", "hub").alias("y")).distinct(), "star-pairs")
    links = _verified(area, texts, nodes, postings, first_pairs, n, percent, "star")
    grouped = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")), area, "star")
    grouped = put(area, grouped.withColumnRenamed("component", "grp"), "star-components")

    area.drop("hubs", "star-pairs")

    # All other pairs: nodes that are not connected yet and meet at an n-gram.
    tagged = put(
        area,
        postings.join(grouped, "node", "left").select(*columns, F.coalesce("grp", "node").alias("grp")),
        "tagged-postings",
    )
    open_grams = put(
        area,
        tagged.groupBy("gram").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.min("size").alias("least")).filter("lo <> hi").select("gram", "least"),
        "open-grams",
    )
    # A posting that cannot meet even the smallest set of its n-gram leaves.
    least = f"greatest(least, ({percent} * size + 99) div 100)"
    left = tagged.join(open_grams, "gram").filter(f"size - pos >= {_required('size', least, percent)}").select(*columns, "grp")
    left = put(area, left, "open-postings")
    area.drop("tagged-postings", "open-grams")
    other = left.select(*(F.col(c).alias(f"{c}_y") for c in left.columns))
    meets = _can_meet("size", "pos", "size_y", "pos_y", percent)
    met = left.join(other, F.expr(f"gram = gram_y AND node < node_y AND grp <> grp_y AND {meets}"))
    rest_pairs = put(area, met.select(F.col("node").alias("x"), F.col("node_y").alias("y")).distinct(), "rest-pairs")
    rest = _verified(area, texts, nodes, postings, rest_pairs, n, percent, "rest")

    area.drop("open-postings", "rest-pairs", "postings")

    edges = links.union(rest).select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = put(area, components(edges, area, "all"), "components")
    linked = found.join(nodes.select("node", "rep", "digest"), "node")
    lows = linked.groupBy("component").agg(F.min(F.struct("rep", "digest")).alias("low"))
    heads = found.join(put(area, lows, "component-firsts"), "component").select("node", "low")
    named = nodes.join(put(area, heads, "heads"), "node", "left").select(
        "node",
        "rep",
        "digest",
        F.coalesce("low.rep", "rep").alias("component_id"),
        F.coalesce("low.digest", "digest").alias("component_digest"),
    )
    return put(area, named, "node-components")


def _hubs(postings: DataFrame) -> DataFrame:
    """Of every n-gram the node in whose order it comes earliest, for its size."""
    best = F.min(F.struct((F.col("pos") / F.col("size")).alias("place"), "node", "size", "pos")).alias("h")
    return (
        postings.groupBy("gram")
        .agg(best, F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("gram", F.col("h.node").alias("hub"), F.col("h.size").alias("hub_size"), F.col("h.pos").alias("hub_pos"))
    )


def _can_meet(x: str, pos_x: str, y: str, pos_y: str, percent: int) -> str:
    """Whether sets of these sizes whose first common n-gram stands at these places can link at all."""
    near = f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"
    return f"{near} AND least({x} - {pos_x}, {y} - {pos_y}) >= {_required(x, y, percent)}"


def _can_link(x: str, y: str, shared: str, percent: int) -> str:
    """Upper bound of the overlap: what the fronts share, and all of the longer rest."""
    rest = f"greatest({x} - {_front(x, percent)}, {y} - {_front(y, percent)})"
    return f"{shared} + {rest} >= {_required(x, y, percent)}"


def _verified(
    area: Tables,
    texts: DataFrame,
    nodes: DataFrame,
    postings: DataFrame,
    pairs: DataFrame,
    n: int,
    percent: int,
    name: str,
) -> DataFrame:
    """The pairs that link."""
    links = put(area, _overlaps(area, texts, nodes, postings, pairs, n, percent, name).select("x", "y"), f"{name}-links")
    area.drop(f"{name}-open", f"{name}-nodes", f"{name}-fragments")
    return links


def _overlaps(
    area: Tables,
    texts: DataFrame,
    nodes: DataFrame,
    postings: DataFrame,
    pairs: DataFrame,
    n: int,
    percent: int,
    name: str,
) -> DataFrame:
    """``x, y, i, nx, ny`` of the pairs that link: partial overlaps counted per fragment, then summed per pair."""
    # The front fragment first: most pairs that met by chance end here.
    px = postings.select(F.col("node").alias("x"), "gram", F.col("size").alias("nx"))
    py = postings.select(F.col("node").alias("node_y"), F.col("gram").alias("gram_y"), F.col("size").alias("ny"))
    front = pairs.join(px, "x").join(py, F.expr("y = node_y AND gram = gram_y"))
    front = front.groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared"), F.first("nx").alias("nx"), F.first("ny").alias("ny"))
    pairs = put(area, front.filter(_can_link("nx", "ny", "shared", percent)).select("x", "y"), f"{name}-open")

    needed = pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))).distinct()
    sources = put(area, nodes.join(needed, "node", "left_semi").select("node", F.col("rep").alias("id"), "digest"), f"{name}-nodes")
    cut = texts.join(sources.hint("merge"), ["id", "digest"]).select("id", "node", "text").mapInArrow(
        _fragment_rows(n, FRAGMENTS), "node long, fragment int, grams array<bigint>"
    )
    # a repeated row brings its set again
    parts = put(area, cut.dropDuplicates(["node", "fragment"]), f"{name}-fragments")
    xs = parts.select(F.col("node").alias("x"), "fragment", F.col("grams").alias("gx"))
    ys = parts.select(F.col("node").alias("node_y"), F.col("fragment").alias("fragment_y"), F.col("grams").alias("gy"))
    partial = (
        pairs.join(xs, "x")
        .join(ys, F.expr("y = node_y AND fragment = fragment_y"))
        .select("x", "y", F.size(F.array_intersect("gx", "gy")).alias("part"), F.size("gx").alias("nx"), F.size("gy").alias("ny"))
    )
    total = partial.groupBy("x", "y").agg(F.sum("part").alias("i"), F.sum("nx").alias("nx"), F.sum("ny").alias("ny"))
    return total.filter(f"100 * i >= {percent} * (nx + ny - i)")


def similarity_join(
    docs: DataFrame, n: int = WORDS, percent: int = THRESHOLD_PERCENT, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The join itself: ``(members, links)``.

    ``members`` has every row of ``docs`` as ``key, class_id, n_shingles, n_links``:
    rows with equal sets are one class, and ``n_links`` counts the other rows that
    a row links with, those of its class included; a row without a word has a null
    class and no link.  ``links`` has every pair of classes that link, once, as
    ``class_x, class_y, id_x, id_y, overlap, n_x, n_y``: an id is the smallest of
    its class (null first), the overlap and the sizes are those of the sets.

    Unlike the components, which leave out pairs that are connected already, all
    pairs that the position bound lets meet are counted, so the work grows with
    the links between different texts; copies are never expanded into pairs.
    """
    area, texts, members, front = _fronts(docs, n, percent, key, text)
    nodes, postings = _postings(area, members, front)
    columns = ["gram", "node", "size", "pos"]
    other = postings.select(*(F.col(c).alias(f"{c}_y") for c in columns))
    meets = _can_meet("size", "pos", "size_y", "pos_y", percent)
    met = postings.join(other, F.expr(f"gram = gram_y AND node < node_y AND {meets}"))
    pairs = put(area, met.select(F.col("node").alias("x"), F.col("node_y").alias("y")).distinct(), "pairs")
    links = put(area, _overlaps(area, texts, nodes, postings, pairs, n, percent, "join"), "links")
    area.drop("postings", "pairs", "join-open", "join-nodes", "join-fragments")

    undo = lambda c: F.when(F.col(c) == LOWEST, F.lit(None).cast("long")).otherwise(F.col(c))
    reps = lambda side: nodes.select(F.col("node").alias(side), F.col("rep").alias(f"id_{side}"))
    named = links.join(reps("x"), "x").join(reps("y"), "y").select(
        F.col("x").alias("class_x"),
        F.col("y").alias("class_y"),
        undo("id_x").alias("id_x"),
        undo("id_y").alias("id_y"),
        F.col("i").alias("overlap"),
        F.col("nx").alias("n_x"),
        F.col("ny").alias("n_y"),
    )
    rows = put(area, members.filter("size > 0").groupBy("node").agg(F.count(F.lit(1)).alias("rows")), "class-rows")
    ends = links.select("x", "y").union(links.select("y", "x"))
    partners = rows.withColumnRenamed("node", "y").join(ends, "y").groupBy("x").agg(F.sum("rows").alias("partners"))
    counts = rows.join(partners.withColumnRenamed("x", "node"), "node", "left").select(
        "node", (F.col("rows") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links")
    )
    full = members.filter("size > 0").join(put(area, counts, "class-links"), "node")
    wordless = members.filter("size = 0").withColumn("node", F.lit(None).cast("long")).withColumn("n_links", F.lit(0).cast("long"))
    shown = lambda df: df.select(
        undo("id").alias(key), F.col("node").alias("class_id"), F.col("size").cast("long").alias("n_shingles"), "n_links"
    )
    return shown(full).union(shown(wordless)), named


def keep_one_per_component(
    docs: DataFrame, n: int = WORDS, percent: int = THRESHOLD_PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest id (null first), then text digest.

    Rows that no text links survive, whether their id is null, repeated or
    their own; a row without a word links with nothing, so all of these stay.
    All columns are unchanged.
    """
    _, named = _named_nodes(docs, n, percent, key, text)
    keep = named.filter("rep = component_id AND digest = component_digest").select(
        F.col("rep").alias("keep_id"), F.col("digest").alias("keep_digest")
    )
    rows = docs.select(F.struct("*").alias("row"), *_keyed(key, text))
    wordless = ~F.coalesce(F.col(f"row.`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = rows.filter(~wordless).join(keep, F.expr("id = keep_id AND digest = keep_digest"), "left_semi")
    # One of equal rows; the window costs no shuffle beyond the join's.
    once = Window.partitionBy("id", "digest").orderBy("id")
    kept = kept.withColumn("n", F.row_number().over(once)).filter("n = 1")
    return kept.select("row.*").union(rows.filter(wordless).select("row.*"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: components of the five-word n-gram join at a similarity of 0.75."""
    return similarity_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
