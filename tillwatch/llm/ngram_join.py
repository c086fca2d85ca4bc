"""Exact self-join of documents by Jaccard similarity of their word n-grams, by vertical partitioning.

All n-grams stand in one global order: ordinary ones by hash, then those that many
documents hold. Linked sets agree in one of their first few n-grams, so only documents
that meet there are candidates, and common n-grams hardly ever come first. The order is
cut into fragments; candidates count their common n-grams fragment by fragment, and the
partial counts are summed per pair. Equal sets are one node. Nodes that meet in an n-gram
are first compared with one of them, then every component with its likeliest partner,
and only what is still apart after that pair by pair, so a large group of copies costs
about as many comparisons as it has members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm.components import connected_components
from tillwatch.llm.near_dedup import shingle_sets
from tillwatch.llm.text import NOT_BLANK, split_words, text_chunks, written


@dataclass(frozen=True)
class NgramJoin:
    """Link rule `100 * common >= percent * all` on distinct `words`-word n-grams.

    N-grams of more than `rare` documents go last in the order, at most `hot_limit` of
    them (the most frequent). Which ones these are changes costs only, never results;
    so does a wrong hit of the bit sets, which have `2 ** bits` bits at any input size.
    """

    percent: int = 80
    words: int = 5
    fragments: int = 16  # of ordinary n-grams; hot ones have as many more
    rare: int = 20
    hot_limit: int = 1 << 22
    bits: int = 27
    block: int = 512  # nodes of an n-gram that one row holds for comparison

    def prefix(self, size: np.ndarray) -> np.ndarray:
        """So many of the first n-grams have one in common with any linked set."""
        return size - (self.percent * size + 99) // 100 + 1

    def needed(self, a: Column, b: Column) -> Column:
        """Least number of common n-grams of linked sets of these sizes."""
        return F.ceil(F.lit(self.percent) * (a + b) / (100 + self.percent))


def ngram_links(docs: DataFrame, shape: NgramJoin = NgramJoin()) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a set
    holds a text's distinct n-grams, or its whole word sequence if that is shorter. Null
    texts and texts without words have no set and no link. `component_id` is the smallest
    doc_id reachable by links, itself included; null ids are passed over. Repeated rows
    are documents with equal sets. Texts of any length are read whole, an empty table
    gives no rows, and columns other than doc_id and text are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hot = _hot_grams(docs, shape)
    sets = written(_sets(docs, hot, shape), "sets")
    stands = sets.filter("n > 0").groupBy("set_hash").agg(F.min("row_id").alias("row_id"))
    nodes = written(sets.join(stands.select("row_id"), "row_id", "left_semi").withColumnRenamed("row_id", "node"), "nodes")
    roots = _components(docs, nodes, hot, shape)

    by_set = nodes.select("set_hash", "node").join(roots, "node", "left").select("set_hash", F.coalesce("root", "node").alias("root"))
    # Sets with very many copies are hot keys of a plain inner join, which Spark splits by size.
    member = sets.select("row_id", "doc_id", "n", "set_hash").join(by_set, "set_hash", "left")
    # Texts without words have equal (empty) sets, but no node.
    member = member.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", -1 - F.col("row_id")).alias("root"))
    heads = member.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return member.join(heads, "root").select("doc_id", "n_shingles", "component_id")


# ---- bit sets of bounded size ---------------------------------------------------------------


def _bit_set(grams: DataFrame, column: str, shape: NgramJoin) -> Broadcast:
    """Bits of the hashes in a column, on every executor; `2 ** bits / 8` bytes however many there are."""
    slot = F.shiftrightunsigned(column, 64 - shape.bits) + 1  # bitmaps count from 1
    chunks = grams.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    held = np.zeros(1 << (shape.bits - 3), np.uint8)
    width = 32_768 // 8
    for row in written(chunks, "bits").toLocalIterator():
        part = np.frombuffer(row.bits, np.uint8)
        held[(row.bucket - 1) * width :][: len(part)] = part[: len(held)]
    return grams.sparkSession.sparkContext.broadcast(held)


def _in_bits(held: np.ndarray, value: np.ndarray, shape: NgramJoin) -> np.ndarray:
    slot = (value >> np.uint64(64 - shape.bits)).astype(np.int64)
    return (held[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


# ---- the order and the sets -----------------------------------------------------------------


def _sizes(doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(doc, np.arange(n + 1))
    return at, np.diff(at)


def _heads(at: np.ndarray, take: np.ndarray) -> np.ndarray:
    """Places of the first `take` entries of each run that begins at `at`."""
    ends = np.cumsum(take)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - take, take) + np.repeat(at[:-1], take)


def _listed(docs: DataFrame, known: Broadcast | None, shape: NgramJoin) -> DataFrame:
    """(gram) the prefix of each text by hash; with `known`, as far as it will reach without the known ones.

    The share of known ones beyond the prefix is taken to be that in it, doubled to be
    safe. What is missed is not counted and stays ordinary, which costs but is not wrong.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches):
            doc, value = shingle_sets(split_words(texts, NOT_BLANK), shape.words)
            at, size = _sizes(doc, len(texts))
            take = np.where(size > 0, shape.prefix(size), 0)
            out = value[_heads(at, take)]
            if known is not None:
                gone = np.bincount(np.repeat(np.arange(len(texts)), take), _in_bits(known.value, out, shape), len(texts))
                further = np.ceil(2 * gone * take / np.maximum(take - gone, 0.5)).astype(np.int64)
                out = value[_heads(at, np.where(gone > 0, np.minimum(size, take + further), 0))]
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["gram"])

    return docs.select("text").mapInArrow(run, "gram long")


def _hot_grams(docs: DataFrame, shape: NgramJoin) -> Broadcast:
    """Bit set of the n-grams that go last.

    Counted first among prefixes by hash; then, of texts that hold a frequent one, as far
    as their prefixes will reach without those.
    """

    def frequent(listed: DataFrame) -> DataFrame:
        return listed.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shape.rare)

    first = written(frequent(_listed(docs, None, shape)), "hot")
    second = frequent(_listed(docs, _bit_set(first, "gram", shape), shape))
    both = written(first.union(second), "hot")
    classes = both.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("grams"))
    least, total = 0, 0
    for row in sorted(classes.collect(), key=lambda r: -r.power):  # one row per power of two
        total += row.grams
        if total > shape.hot_limit:
            least = 1 << (row.power + 1)
            break
    return _bit_set(both.filter(F.col("n") >= least), "gram", shape)


SETS = "row_id long, doc_id long, n long, set_hash binary, prefix array<long>, s0 long, s1 long, s2 long, s3 long, s4 long, s5 long, s6 long, s7 long"
SKETCH = [f"s{i}" for i in range(8)]


def _sets(docs: DataFrame, hot: Broadcast, shape: NgramJoin) -> DataFrame:
    """Size, hash and prefix of each set, and which of 512 slots its n-grams fall in.

    Row ids are unique once the result is written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = TaskContext.get().partitionId() << 33
        for batch, texts in text_chunks(batches):
            n = len(texts)
            doc, value = shingle_sets(split_words(texts, NOT_BLANK), shape.words)
            at, size = _sizes(doc, n)
            hashes = [hashlib.blake2b(value[at[i] : at[i + 1]].tobytes(), digest_size=16).digest() for i in range(n)]
            slots = np.zeros((n, 512), bool)
            slots[doc, (value & np.uint64(511)).astype(np.int64)] = True
            sketch = np.packbits(slots, axis=1).view(np.int64)
            ordered = value[np.lexsort((value, _in_bits(hot.value, value, shape), doc))]
            take = np.where(size > 0, shape.prefix(size), 0)
            offsets = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ordered[_heads(at, take)].view(np.int64)))
            columns = [pa.array(np.arange(row_id, row_id + n)), batch.column("doc_id"), pa.array(size), pa.array(hashes, pa.binary()), prefix]
            columns += [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(8)]
            row_id += n
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SETS.split(", ")])

    return docs.mapInArrow(run, SETS)


# ---- candidates -----------------------------------------------------------------------------


def _components(docs: DataFrame, nodes: DataFrame, hot: Broadcast, shape: NgramJoin) -> DataFrame:
    """(node, root) of all nodes that have a link."""
    buckets = written(_buckets(nodes, shape), "buckets")
    sizes = nodes.select("node", "n")
    segments = Segments(docs, nodes, hot, shape)
    roots = connected_components(written(segments.linked(_star_pairs(buckets, shape), sizes), "links"))
    # Each component with its likeliest partner as long as many of them are linked; then all that is left.
    likeliest = True
    while True:
        pairs = written(_across(buckets, nodes, roots, shape, likeliest), "across")
        compared = 0 if pairs.isEmpty() else pairs.count()
        if not compared:
            return roots
        found = written(segments.linked(pairs, sizes), "links")
        more = found.count()
        if more:
            roots = _joined(roots, found)
        if not likeliest:
            return roots
        likeliest = more * 10 > compared


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`roots` with further links: only the components that these join are looked at again."""
    ends = links
    for c in ("a", "b"):
        ends = ends.join(roots.toDF(c, f"root_{c}"), c, "left")
    between = ends.select(*[F.coalesce(f"root_{c}", c).alias(c) for c in ("a", "b")])
    moved = connected_components(between).toDF("old", "new")
    held = roots.join(moved, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    # Nodes that had no link so far stand for themselves among the joined components.
    single = moved.join(roots.select(F.col("root").alias("old")).distinct(), "old", "left_anti").toDF("node", "root")
    return written(held.union(single), "roots")


def _buckets(nodes: DataFrame, shape: NgramJoin) -> DataFrame:
    """(gram, node, n, pos) of prefix n-grams that several nodes hold; `pos` counts from 1."""
    listed = nodes.select(F.explode("prefix").alias("gram"))
    shared = _bit_set(listed.groupBy("gram").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1"), "gram", shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            width = np.diff(prefix.offsets.to_numpy())
            gram = prefix.flatten().to_numpy()
            row = np.repeat(np.arange(len(width)), width)
            pos = np.arange(len(gram)) - np.repeat(np.cumsum(width) - width, width) + 1
            keep = _in_bits(shared.value, gram.view(np.uint64), shape)
            node, n = (batch.column(c).to_numpy()[row[keep]] for c in ("node", "n"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[keep]), pa.array(node), pa.array(n), pa.array(pos[keep])], ["gram", "node", "n", "pos"]
            )

    return nodes.select("node", "n", "prefix").mapInArrow(run, "gram long, node long, n long, pos long")


def _may_link(a: Column, b: Column, shape: NgramJoin) -> Column:
    """Whether sizes allow a link, and positions leave enough n-grams to agree from here on."""
    small, large = F.least(a.n, b.n), F.greatest(a.n, b.n)
    rest = F.lit(1) + F.least(a.n - a.pos, b.n - b.pos)
    return (small * 100 >= large * shape.percent) & (rest >= shape.needed(a.n, b.n))


def _star_pairs(buckets: DataFrame, shape: NgramJoin) -> DataFrame:
    """Every node of an n-gram with one of them, the same in most n-grams that they share."""
    place = F.struct(F.xxhash64("node").alias("order"), "node", "n", "pos")
    centres = buckets.groupBy("gram").agg(F.min(place).alias("c"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = buckets.select("gram", F.struct("node", "n", "pos").alias("m")).join(centres, "gram").filter("m.node <> c.node")
    fit = met.filter(_may_link(F.col("c"), F.col("m"), shape))
    return fit.select(F.least("c.node", "m.node").alias("a"), F.greatest("c.node", "m.node").alias("b")).distinct()


def _across(buckets: DataFrame, nodes: DataFrame, roots: DataFrame, shape: NgramJoin, likeliest: bool) -> DataFrame:
    """Pairs (a, b) of nodes that share a prefix n-gram, may link and lie in different components.

    Of each n-gram the component with most nodes is not compared with itself: the others
    look through its nodes, held in rows of at most about `block`. With `likeliest` each
    component keeps one pair, the one with fewest slots that differ.
    """
    rooted = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_root = rooted.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("nodes"))
    spread = per_root.groupBy("gram").agg(
        F.max(F.struct("nodes", "root")).alias("lead"), F.sum("nodes").alias("members"), F.count(F.lit(1)).alias("roots")
    )
    spread = spread.filter("roots > 1").select("gram", F.col("lead.root").alias("lead"), F.ceil(F.col("members") / shape.block).cast("int").alias("blocks"))
    still = rooted.join(spread, "gram").join(nodes.select("node", *SKETCH), "node")
    still = still.select("gram", "lead", F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.struct("node", "root", "n", "pos", *SKETCH).alias("m"))
    held = still.groupBy("gram", "block").agg(F.collect_list("m").alias("members"))
    looking = still.filter("m.root <> lead").select("gram", F.col("m").alias("p"))

    def differs(m: Column) -> Column:
        """Slots that only one of the sets fills: no more than the n-grams that only one holds."""
        return sum((F.bit_count(F.col(f"p.{s}").bitwiseXOR(m[s])) for s in SKETCH), F.lit(0))

    def candidate(m: Column) -> Column:
        p = F.col("p")
        apart = p.n + m.n - F.lit(2) * shape.needed(p.n, m.n)
        return (m.root != p.root) & _may_link(p, m, shape) & (differs(m) <= apart)

    found = looking.join(held, "gram").select("p", F.filter("members", candidate).alias("near"))
    if likeliest:
        closest = F.array_min(F.transform("near", lambda m: F.struct(differs(m).alias("apart"), m.node.alias("node"))))
        met = found.select(F.col("p.root").alias("root"), F.col("p.node").alias("own"), closest.alias("best")).filter("best is not null")
        best = met.groupBy("root").agg(F.min(F.struct("best.apart", "best.node", "own")).alias("best"))
        a, b = F.col("best.node"), F.col("best.own")
        return best.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    met = found.select(F.col("p.node").alias("own"), F.explode(F.transform("near", lambda m: m.node)).alias("node"))
    return met.select(F.least("own", "node").alias("a"), F.greatest("own", "node").alias("b")).distinct()


# ---- partial counts by fragment --------------------------------------------------------------


class Segments:
    """The n-grams of nodes, cut at the borders of the fragments; nodes are read as candidates need them."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, hot: Broadcast, shape: NgramJoin) -> None:
        self.docs, self.nodes, self.hot, self.shape = docs, nodes, hot, shape
        self.stored: DataFrame | None = None

    def linked(self, pairs: DataFrame, sizes: DataFrame) -> DataFrame:
        """Pairs whose common n-grams, counted in each fragment and summed, are enough."""
        pairs = written(pairs, "candidates")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        if self.stored is not None:
            wanted = wanted.join(self.stored.select("node").distinct(), "node", "left_anti")
        new = written(self._read(written(wanted, "wanted")), "segments")
        self.stored = new if self.stored is None else self.stored.union(new)
        left = self.stored.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("grams_a"))
        right = self.stored.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("grams_b"))
        met = pairs.join(left, "a").join(right, ["b", "fragment"])
        partial = met.select("a", "b", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("part"))
        summed = partial.groupBy("a", "b").agg(F.sum("part").alias("common"))
        sized = summed.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
        every = F.col("n_a") + F.col("n_b") - F.col("common")
        return sized.filter((F.col("common") * 100 >= every * self.shape.percent) & (F.col("common") > 0)).select("a", "b")

    def _read(self, wanted: DataFrame) -> DataFrame:
        """(node, fragment, grams) of the wanted nodes; a bit set passes over most texts, a join is exact."""
        hot, shape = self.hot, self.shape
        keyed = wanted.join(self.nodes.select("node", "doc_id", "set_hash", "n"), "node")
        ids = _bit_set(keyed.select(F.xxhash64("doc_id").alias("id")), "id", shape)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                batch = whole.filter(pa.array(_in_bits(ids.value, whole.column("id").to_numpy().view(np.uint64), shape)))
                for _, texts in text_chunks(iter([batch])):
                    yield from _segments(texts, hot.value, shape)

        docs = self.docs.select("text", F.xxhash64("doc_id").alias("id"))
        cut = docs.mapInArrow(run, "set_hash binary, fragment int, grams array<long>")
        # Copies of a set give equal segments; one of each stays.
        once = cut.join(keyed.select("set_hash", "node"), "set_hash").groupBy("node", "fragment").agg(F.first("grams").alias("grams"))
        return once


def _segments(texts: list[bytes], hot: np.ndarray, shape: NgramJoin) -> Iterator[pa.RecordBatch]:
    doc, value = shingle_sets(split_words(texts, NOT_BLANK), shape.words)
    at, size = _sizes(doc, len(texts))
    hashes = [hashlib.blake2b(value[at[i] : at[i + 1]].tobytes(), digest_size=16).digest() for i in range(len(texts))]
    last = _in_bits(hot, value, shape)
    step = (1 << 64) // shape.fragments
    fragment = (value // np.uint64(step)).astype(np.int64) + np.where(last, shape.fragments, 0)
    order = np.lexsort((value, fragment, doc))
    doc, value, fragment = doc[order], value[order], fragment[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (fragment[1:] != fragment[:-1])
    first = np.flatnonzero(new)
    offsets = pa.array(np.append(first, len(doc)).astype(np.int32))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([hashes[d] for d in doc[first].tolist()], pa.binary()),
            pa.array(fragment[first].astype(np.int32)),
            pa.ListArray.from_arrays(offsets, pa.array(value.view(np.int64))),
        ],
        ["set_hash", "fragment", "grams"],
    )
