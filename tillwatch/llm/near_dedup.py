"""Near-duplicate documents by HyperMinHash.

One pass over the texts gives each document a hash of its whole shingle set and a
sketch: per bucket the smallest hash, compressed to its count of leading zeros and
a few bits behind them. Documents with equal sets become one node. Bands of
registers deal nodes into buckets. Small sets fill too few registers for that and
are dealt by their rarest shingles instead, which misses no link. In each bucket
every node meets one centre, and the estimate from the registers, corrected for
chance collisions, says which pairs
are worth comparing in full (of small sets all). Verified links join nodes to components. Buckets that
still hold more than one component are then compared block by block, so no link
between members of different components is lost, however full a bucket is; those that
overlap are joined first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.components import connected_components
from tillwatch.llm.text import NOT_BLANK, Words, mix, split_words, text_chunks, written


@dataclass(frozen=True)
class HyperMinHash:
    """Shape of the sketch and the link rule `100 * common >= percent * all`.

    256 registers of 16 bits (6 for leading zeros, 10 behind them); 51 bands of 5
    miss a pair at 80 percent with probability 2e-9. `sigmas` standard errors below
    the threshold a pair is still compared in full, so the estimate drops about 3e-7
    of such pairs. Of sets with less than `exact_below` shingles nothing is missed.
    """

    percent: int = 80
    shingle: int = 5
    registers: int = 256
    mantissa: int = 10
    bands: int = 51
    rows: int = 5
    sigmas: float = 5.0
    exact_below: int = 100
    block: int = 4096  # nodes of a bucket whose sketches are compared with each other in one task
    text_block: int = 1024  # the same of whole texts

    @property
    def small(self) -> int:
        """Largest set that a set below `exact_below` can be linked with."""
        return 100 * self.exact_below // self.percent


EMPTY = np.uint16(0xFFFF)
HOT_SHINGLE = 20
HELD_PAIRS = 1 << 20  # of a group, before they are thinned out
MOST_PARTS = 1 << 12  # of a block
SLOTS = 512  # which of them a set's shingles fall in tells exactly that some pairs are too far apart


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) of k-word shingles; a text of fewer words is one shingle as a whole."""
    valid = words.gram_valid(k)
    doc, value = words.doc[: len(valid)][valid], words.gram_hash(k)[valid]
    sizes = words.count()
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):
        whole = [_sequence_hash(words.hash[words.first[d] : words.first[d + 1]]) for d in short]
        doc, value = np.concatenate([doc, short]), np.concatenate([value, np.asarray(whole, np.uint64)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def _sequence_hash(words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little")


def sketches(doc: np.ndarray, value: np.ndarray, n_docs: int, shape: HyperMinHash) -> np.ndarray:
    """Registers per text: leading zeros and mantissa of the smallest hash of each bucket."""
    bits = shape.registers.bit_length() - 1
    hashed = mix(value + np.uint64(0x5851F42D4C957F2D))
    bucket = (hashed >> np.uint64(64 - bits)).astype(np.int64)
    rest = hashed << np.uint64(bits)  # compared by value; its low bits are zero
    smallest = np.full(n_docs * shape.registers, np.iinfo(np.uint64).max, np.uint64)
    place = doc * shape.registers + bucket
    order = np.lexsort((rest, place))
    place, rest = place[order], rest[order]
    lead = np.ones(len(place), bool)
    lead[1:] = place[1:] != place[:-1]
    smallest[place[lead]] = rest[lead]
    # The exponent of the floating-point form is the position of the leading one.
    filled = smallest != np.iinfo(np.uint64).max
    top = np.frexp((smallest >> np.uint64(11)).astype(np.float64))[1]  # 53 bits stay exact
    zeros = np.clip(53 - top, 0, 61).astype(np.uint64)
    shifted = (smallest << zeros) << np.uint64(1)
    register = (zeros << np.uint64(shape.mantissa)) | (shifted >> np.uint64(64 - shape.mantissa))
    out = np.where(filled, register, EMPTY).astype(np.uint16)
    return out.reshape(n_docs, shape.registers)


def band_keys(registers: np.ndarray, shape: HyperMinHash) -> np.ndarray:
    """One key per band; 0 where all registers of the band are empty (no key)."""
    used = registers[:, : shape.bands * shape.rows].reshape(len(registers), shape.bands, shape.rows)
    key = np.arange(1, shape.bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    key = np.repeat(key, len(registers), 0)
    for j in range(shape.rows):
        key = mix(key + used[:, :, j].astype(np.uint64) + np.uint64(1))
    key[(used == EMPTY).all(2)] = 0
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, chance) -> np.ndarray:
    """Similarity of sketches row by row, less the share of registers that agree by chance."""
    same = np.count_nonzero(a == b, axis=-1)
    empty_a, empty_b = a == EMPTY, b == EMPTY
    filled = a.shape[-1] if a.ndim > b.ndim else b.shape[-1]
    if empty_a.any() and empty_b.any():
        neither = np.count_nonzero(empty_a & empty_b, axis=-1)
        same, filled = same - neither, filled - neither
    share = same / np.maximum(1, filled)
    return (share - chance) / (1 - chance)


def chance_of(size: np.ndarray, shape: HyperMinHash) -> np.ndarray:
    """Probability that registers of unrelated sets of about this size agree.

    With u values in a bucket the smallest lies in the cell of leading zeros z with
    probability mass(z), and in one of the cell's mantissas about evenly. Sizes of
    linked sets differ by a fifth at most, which changes little.
    """
    u = np.maximum(1.0, np.asarray(size) / shape.registers)[:, None]
    z = np.arange(40)
    mass = (1 - 2.0 ** -(z + 1.0)) ** u - (1 - 2.0**-z.astype(float)) ** u
    return (mass**2).sum(1) / 2**shape.mantissa


SKETCH = "row_id long, doc_id long, text_hash long, n_shingles long, set_hash binary, registers binary, slots binary, shingles array<long>"


def sketch_documents(docs: DataFrame, shape: HyperMinHash) -> DataFrame:
    """One row per document; row ids are unique once the result is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = TaskContext.get().partitionId() << 33
        for batch, texts in text_chunks(batches):
            n = len(texts)
            doc, value = shingle_sets(split_words(texts, NOT_BLANK), shape.shingle)
            registers = sketches(doc, value, n, shape)
            at = np.searchsorted(doc, np.arange(n + 1))
            sizes = np.diff(at)
            small = np.where(sizes <= shape.small, sizes, 0)
            listed = value[np.repeat(small > 0, sizes)].view(np.int64)
            offsets = np.concatenate([[0], np.cumsum(small)]).astype(np.int32)
            slots = np.zeros((n, SLOTS), bool)
            slots[doc, (value % np.uint64(SLOTS)).astype(np.int64)] = True
            slots = np.packbits(slots, axis=1)
            hashes = [hashlib.blake2b(value[at[i] : at[i + 1]].tobytes(), digest_size=16).digest() for i in range(n)]
            columns = [
                pa.array(np.arange(row_id, row_id + n)),
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(sizes),
                pa.array(hashes, pa.binary()),
                pa.array([r.tobytes() for r in registers], pa.binary()),
                pa.array([s.tobytes() for s in slots], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(listed)),
            ]
            row_id += n
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SKETCH.split(", ")])

    return _keyed(docs).mapInArrow(run, SKETCH)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def near_duplicates(docs: DataFrame, shape: HyperMinHash = HyperMinHash()) -> DataFrame:
    """Per row of `docs`: row_id, doc_id, text_hash, n_shingles, component_id, kept.

    Words are runs of characters other than ASCII white space, A-Z lower-cased.
    Documents are linked when their sets of shingles are at least `percent` similar;
    a text of fewer words is one shingle, a null or empty one has none and is linked
    with nothing. `component_id` is the smallest doc_id reachable (null ids are
    passed over; null if there are no others); exactly one row of a component is
    kept, the one with the smallest doc_id. Rows with equal ids are told apart by
    their texts; an empty table gives no rows.
    """
    sketched = written(sketch_documents(docs, shape), "sketch")
    of_set = sketched.filter("n_shingles > 0").groupBy("set_hash")
    # The document that stands for a set has to be found again by id and text.
    stands = F.min(F.struct("row_id", "doc_id", "text_hash", "n_shingles", "registers", "slots", "shingles")).alias("s")
    nodes = written(of_set.agg(stands).select("set_hash", "s.*").withColumnRenamed("row_id", "node"), "nodes")
    roots = _components(docs, nodes, shape)

    by_set = nodes.select("set_hash", "node").join(roots, "node", "left")
    by_set = by_set.select("set_hash", F.coalesce("root", "node").alias("root"))
    # A set with very many copies is joined once per row; Spark splits that key by size.
    member = sketched.select("row_id", "doc_id", "text_hash", "n_shingles", "set_hash").join(
        by_set, "set_hash", "left"
    )
    empty = F.col("n_shingles") == 0
    member = member.select(
        "row_id", "doc_id", "text_hash", "n_shingles", F.when(empty, F.col("row_id")).otherwise(F.col("root")).alias("root")
    )
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_id"))
    heads = member.groupBy("root").agg(F.min(first).alias("head"))
    heads = heads.select("root", F.col("head.doc_id").alias("component_id"), F.col("head.row_id").alias("head_row"))
    return member.join(heads, "root").select(
        "row_id", "doc_id", "text_hash", "n_shingles", "component_id", (F.col("row_id") == F.col("head_row")).alias("kept")
    )


def keep_one(docs: DataFrame, shape: HyperMinHash = HyperMinHash()) -> DataFrame:
    """`docs` with one row of each component; columns unchanged."""
    kept = near_duplicates(docs, shape).filter("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashed = docs.withColumn("_text_hash", F.xxhash64(text))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & (F.col("_text_hash") == F.col("_kept_hash"))
    # Rows that repeat id and text are one document; a semi join and then one row of each.
    joined = hashed.join(kept, same, "left_semi")
    return joined.dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash")


def _components(docs: DataFrame, nodes: DataFrame, shape: HyperMinHash) -> DataFrame:
    """(node, root) of all nodes that have a link."""
    buckets = written(_buckets(nodes, shape), "buckets")
    light = nodes.select("node", "n_shingles", "registers", "slots")
    pairs = written(_near(_star_pairs(buckets), light, shape), "pairs")
    ids = _ends(pairs)
    texts = written(_texts(docs, nodes.join(ids, "node", "left_semi")), "texts")

    # First one pair per node, the likeliest; most others then lie within a component.
    likeliest = pairs.groupBy("b").agg(F.max(F.struct("similar", "a")).alias("best"))
    links = written(_verified(likeliest.select(F.col("best.a").alias("a"), "b"), texts, shape), "links")
    roots = connected_components(links)
    links = links.union(written(_verified(_across(pairs, roots), texts, shape), "links"))
    roots = connected_components(links)

    # What no centre has settled: buckets with several components, compared in blocks.
    # First every node in its fullest bucket, and of the near pairs there only a spanning forest.
    blocks = _blocks(buckets, roots, light, shape, fullest=True)
    forest = written(_by_group(blocks, _forest_of(shape), shape, PAIR).distinct(), "forest")
    if not forest.isEmpty():
        texts = _more_texts(docs, nodes, texts, _ends(forest))
        found = written(_verified(forest, texts, shape), "links")
        links = links.union(found)
        roots = connected_components(links)
    # Then all that are left: near pairs are compared in full where they meet, and only links come out.
    blocks = _blocks(buckets, roots, light, shape, fullest=False)
    near = written(_by_group(blocks, _near_of(shape), shape, NEAR), "near-blocks")
    if near.isEmpty():
        return roots
    texts = _more_texts(docs, nodes, texts, near.select("node").distinct())
    whole = near.join(light, "node").join(texts, "node")
    last = written(_by_group(whole, _links_of(shape), shape, PAIR).distinct(), "links")
    return roots if last.isEmpty() else connected_components(links.union(last))


def _more_texts(docs: DataFrame, nodes: DataFrame, texts: DataFrame, wanted: DataFrame) -> DataFrame:
    missing = written(wanted.join(texts.select("node"), "node", "left_anti"), "missing")
    if missing.isEmpty():
        return texts
    return texts.union(written(_texts(docs, nodes.join(missing, "node", "left_semi")), "texts"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def _buckets(nodes: DataFrame, shape: HyperMinHash) -> DataFrame:
    """(key, node, centre) of nodes whose key occurs more than once: bands, or rare shingles of small sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            registers = _registers(batch.column("registers").to_pylist(), shape)
            if len(registers):
                keys = band_keys(registers, shape)
                node = np.repeat(batch.column("node").to_numpy(), shape.bands)
                used = keys.ravel() != 0
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()[used]), pa.array(node[used])], ["key", "node"])

    large = nodes.filter(F.col("n_shingles") >= shape.exact_below)
    keyed = large.select("node", "registers").mapInArrow(run, "key long, node long").union(_prefixes(nodes, shape))
    # The same order in all bands, so that a node meets few different centres.
    first = F.min(F.struct(F.xxhash64("node"), F.col("node"))).alias("first")
    # Keys that the same nodes share, as those of one passage, are one bucket: equal by count and 128 bits of hashes.
    same = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"same{k}") for k in (0, 1)]
    centres = keyed.groupBy("key").agg(first, F.count(F.lit(1)).alias("members"), *same).filter("members > 1")
    once = centres.groupBy("members", "same0", "same1").agg(F.min(F.struct("key", "first.node")).alias("c"))
    return keyed.join(once.select("c.key", F.col("c.node").alias("centre")), "key")


def _prefixes(nodes: DataFrame, shape: HyperMinHash) -> DataFrame:
    """(key, node): the first shingles of small sets in one order of all shingles, rare ones first.

    Linked sets of n shingles have `percent` of n in common at least, so one of the
    first n - that + 1 of each is common to both. Only shingles of many sets are put
    last, as the others are rare anyway.
    """
    listed = nodes.filter((F.col("n_shingles") > 0) & (F.col("n_shingles") <= shape.small))
    listed = listed.select("node", "n_shingles", F.explode("shingles").alias("shingle"))
    hot = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).filter(F.col("sets") > HOT_SHINGLE)
    ranked = listed.join(hot, "shingle", "left").select(
        "node", "n_shingles", F.struct(F.coalesce("sets", F.lit(0)).alias("sets"), F.xxhash64("shingle").alias("hash"), "shingle").alias("s")
    )
    ordered = ranked.groupBy("node", "n_shingles").agg(F.array_sort(F.collect_list("s")).alias("s"))
    common = F.expr(f"cast((n_shingles * {shape.percent} + 99) div 100 as int)")
    first = F.slice("s", F.lit(1), F.col("n_shingles").cast("int") - common + 1)
    return ordered.select(F.explode(first).alias("s"), "node").select(F.xxhash64(F.lit("prefix"), "s.shingle").alias("key"), "node")


def _registers(values: list[bytes], shape: HyperMinHash) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint16).reshape(len(values), shape.registers)


def _star_pairs(buckets: DataFrame) -> DataFrame:
    return buckets.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()


def _near(pairs: DataFrame, light: DataFrame, shape: HyperMinHash) -> DataFrame:
    """Pairs whose estimate may reach the threshold, with the estimate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, size_a, size_b = (batch.column(n).to_numpy() for n in ("a", "b", "size_a", "size_b"))
            if not len(a):
                continue
            left, right = (_registers(batch.column(n).to_pylist(), shape) for n in ("registers_a", "registers_b"))
            similar = estimate(left, right, chance_of(size_a, shape))
            near = _possible(similar, size_a, size_b, shape)
            near &= _within(*(_slots(batch.column(n).to_pylist()) for n in ("slots_a", "slots_b")), size_a, size_b, shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[near]), pa.array(b[near]), pa.array(similar[near])], ["a", "b", "similar"]
            )

    left = light.toDF("a", "size_a", "registers_a", "slots_a")
    right = light.toDF("b", "size_b", "registers_b", "slots_b")
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long, similar double")


def _possible(similar, size_a, size_b, shape: HyperMinHash) -> np.ndarray:
    sizes_fit = 100 * np.minimum(size_a, size_b) >= shape.percent * np.maximum(size_a, size_b)
    return sizes_fit & (similar >= np.minimum(_least(size_a, shape), _least(size_b, shape)))


def _slots(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint64).reshape(len(values), SLOTS // 64)


def _within(a: np.ndarray, b: np.ndarray, size_a, size_b, shape: HyperMinHash) -> np.ndarray:
    """Whether slots differ in no more places than linked sets have shingles that only one holds; drops no link."""
    both = size_a + size_b
    common = -(-shape.percent * both // (100 + shape.percent))
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64) <= both - 2 * common


def _least(size: np.ndarray, shape: HyperMinHash) -> np.ndarray:
    """Least estimate that still calls for a comparison; small sets are compared whatever it is."""
    t, size = shape.percent / 100, np.asarray(size)
    filled = np.maximum(1, shape.registers * (1 - np.exp(-size / shape.registers)))
    return np.where(size < shape.exact_below, -np.inf, t - shape.sigmas * np.sqrt(t * (1 - t) / filled))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the documents that stand for nodes; one scan, few rows come out."""
    wanted = wanted.select("node", F.col("doc_id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash"))
    return _keyed(docs).join(wanted, same).select("node", "text").dropDuplicates(["node"])


def _verified(pairs: DataFrame, texts: DataFrame, shape: HyperMinHash) -> DataFrame:
    """Pairs whose full sets reach the threshold. Sets are built in the tasks that compare them."""

    def sets(texts: list[bytes]) -> list[np.ndarray]:
        doc, value = shingle_sets(split_words(texts, NOT_BLANK), shape.shingle)
        return np.split(value, np.searchsorted(doc, np.arange(1, len(texts))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, np.ndarray] = b"", np.zeros(0, np.uint64)
        for batch, left_texts in text_chunks(batches, "text_a"):
            linked = []
            for left, right in zip(left_texts, batch.column("text_b").to_pylist(), strict=True):
                if left != last[0]:
                    last = left, sets([left])[0]
                other = sets([right.encode()])[0]
                common = len(np.intersect1d(last[1], other, assume_unique=True))
                linked.append(100 * common >= shape.percent * (len(last[1]) + len(other) - common) and common > 0)
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    left = texts.toDF("a", "text_a")
    right = texts.toDF("b", "text_b")
    joined = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long")


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet connected."""
    ra = roots.toDF("a", "root_a")
    rb = roots.toDF("b", "root_b")
    with_roots = pairs.join(ra, "a", "left").join(rb, "b", "left")
    differ = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    return with_roots.filter(differ).select("a", "b")


PAIR = "a long, b long"
NEAR = "key long, x int, y int, node long, root long, block int"


def _blocks(buckets: DataFrame, roots: DataFrame, light: DataFrame, shape: HyperMinHash, fullest: bool) -> DataFrame:
    """Nodes of the buckets that hold several components, dealt to pairs of blocks (key, x, y).

    A bucket of n nodes is cut into blocks; each pair of blocks is one group of
    bounded size. With `fullest` a node only takes part in its fullest bucket.
    """
    rooted = buckets.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    # A centre has met all others: a bucket of two is settled.
    several = rooted.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members")
    )
    several = several.filter("low <> high and members > 2")
    dealt = rooted.join(several.select("key", "members"), "key")
    if fullest:
        best = dealt.groupBy("node").agg(
            F.max(F.struct("members", "key")).alias("best"), F.first("root").alias("root")
        )
        dealt = best.select("best.key", "node", "root", "best.members")
    else:
        dealt = _families(written(dealt, "crowded"))
    n_blocks = F.ceil(F.col("members") / shape.block).cast("int")
    dealt = dealt.withColumn("n_blocks", n_blocks)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "n_blocks").cast("int"))
    meets = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    copies = dealt.select("key", "node", "root", "block", meets)
    copies = copies.select(
        "key", "node", "root", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    )
    return copies.join(light, "node")


def _families(dealt: DataFrame) -> DataFrame:
    """(key, node, root, members): buckets that share a quarter of their nodes, or more, with a fuller one become one with it.

    A family of texts, or texts around one passage, fills many buckets with ever other parts of
    it; together each node, and each pair, comes once. All pairs of a bucket still meet. It is only done where
    it saves comparisons.
    """
    fullest = dealt.groupBy("node").agg(F.max(F.struct("members", "key")).alias("best")).select("node", "best.key")
    shares = dealt.join(fullest.withColumnRenamed("key", "home"), "node").groupBy("key", "members", "home")
    most = shares.agg(F.count(F.lit(1)).alias("held")).groupBy("key", "members").agg(F.max(F.struct("held", "home")).alias("most"))
    shared = F.col("most.held") * 4 >= F.col("members")
    homes = written(most.select("key", "members", F.when(shared, F.col("most.home")).otherwise(F.col("key")).alias("home")), "homes")
    family = dealt.join(homes.select("key", "home"), "key").select("home", "node", "root").distinct()
    family = written(family, "families")
    apart = homes.groupBy("home").agg(F.sum(F.col("members") * F.col("members")).alias("pairs"))
    worth = family.groupBy("home").agg(F.count(F.lit(1)).alias("size")).join(apart, "home")
    worth = written(worth.filter("size * size <= pairs").select("home", "size"), "worth")
    key = F.xxhash64(F.lit("family"), "home").alias("key")  # a bucket that stays may have the name of a family
    together = family.join(worth, "home").select(key, "node", "root", F.col("size").alias("members"))
    stay = homes.join(worth, "home", "left_anti").select("key")
    return together.unionByName(dealt.join(stay, "key", "left_semi"))


Group = dict[str, np.ndarray]


def _by_group(blocks: DataFrame, compare: Callable, shape: HyperMinHash, schema: str) -> DataFrame:
    """`compare` for each group (key, x, y), sorted by block and node; most groups are tiny, so many in one go."""
    place = ["key", "x", "y"]
    dealt = blocks.repartition(*place).sortWithinPartitions(*place, "block", "node")
    names = [part.split()[0] for part in schema.split(", ")]

    def columns_of(table: pa.Table) -> Group:
        out = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("registers", "slots", "text")}
        out["registers"] = _registers(table.column("registers").to_pylist(), shape)
        out["slots"] = _slots(table.column("slots").to_pylist())
        if "text" in table.column_names:
            out["text"] = np.asarray(table.column("text").to_pylist(), object)
        return out

    def results(data: Group, cuts: list[int]) -> pa.RecordBatch:
        found = [
            compare({c: v[s:e] for c, v in data.items()})
            for s, e in zip(cuts, cuts[1:], strict=False)
            if (data["root"][s:e] != data["root"][s]).any()
        ]
        columns = [np.concatenate([np.zeros(0, np.int64), *(f[n] for f in found)]) for n in names]
        kinds = [pa.int32() if " int" in part else pa.int64() for part in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            ends = [batch.column(c)[-1].as_py() for c in place]
            if ends == [held[0].column(c)[0].as_py() for c in place]:
                continue  # still one group
            table = pa.Table.from_batches(held)
            *whole, last = _cuts(data := columns_of(table))
            yield results(data, [*whole, last])
            held = table.slice(last).combine_chunks().to_batches()
        if held:
            data = columns_of(pa.Table.from_batches(held))
            yield results(data, [*_cuts(data), len(data["key"])])

    return dealt.mapInArrow(run, schema)


def _cuts(data: Group) -> list[int]:
    """Where the groups begin."""
    change = np.zeros(len(data["key"]), bool)
    change[0] = True
    for c in ("key", "x", "y"):
        change[1:] |= data[c][1:] != data[c][:-1]
    return np.flatnonzero(change).tolist()


def _near_pairs(group: Group, shape: HyperMinHash) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each node its place in the group, those of others that may be similar enough and are in different
    components, and estimates.

    Each pair comes once: with the later nodes of the same block, or all of the other one.
    """
    registers, slots, root, size, block = (group[c] for c in ("registers", "slots", "root", "n_shingles", "block"))
    n_x = int((block == group["x"][0]).sum())
    same_block = group["x"][0] == group["y"][0]
    chance = chance_of(size, shape)
    least = _least(size, shape)
    empty = np.packbits(registers == EMPTY, axis=1).view(np.uint64)
    some_empty = bool(empty.any())
    for i in range(n_x):
        low = i + 1 if same_block else n_x
        equal = (registers[low:] == registers[i]).view(np.uint64)
        same = np.bitwise_count(equal).sum(1, dtype=np.int64)
        filled = shape.registers
        if some_empty:
            neither = np.bitwise_count(empty[low:] & empty[i]).sum(1, dtype=np.int64)
            same, filled = same - neither, np.maximum(1, shape.registers - neither)
        similar = (same / filled - chance[i]) / (1 - chance[i])
        js = np.flatnonzero(similar >= np.minimum(least[low:], least[i]))
        if not len(js):
            continue
        at = js + low
        fits = 100 * np.minimum(size[i], size[at]) >= shape.percent * np.maximum(size[i], size[at])
        fits &= root[at] != root[i]
        fits &= _within(slots[i], slots[at], size[i], size[at], shape)
        if fits.any():
            yield i, at[fits], similar[js[fits]]


def _flat(found: list[tuple[int, np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs, and their estimates."""
    pairs = [np.zeros((0, 2), np.int64), *(np.stack([np.full(len(at), i), at], 1) for i, at, _ in found)]
    return [(np.concatenate(pairs), np.concatenate([np.zeros(0), *(similar for *_, similar in found)]))]


def _as_pairs(node: np.ndarray, pairs: np.ndarray) -> Group:
    a, b = node[pairs[:, 0]], node[pairs[:, 1]]
    return {"a": np.minimum(a, b), "b": np.maximum(a, b)}


def _forest_of(shape: HyperMinHash) -> Callable[[Group], Group]:
    """Near pairs of a group, likeliest first, as long as they join components that are still apart.

    A text with many variants then meets each of them once, before variants meet
    each other.
    """

    def compare(group: Group) -> Group:
        kept, waiting, held = [], [], 0
        for found in _near_pairs(group, shape):
            waiting.append(found)
            held += len(found[1])
            if held > HELD_PAIRS:  # a forest of all is one of the forests of parts
                kept, waiting, held = [_forest([*kept, *_flat(waiting)], group)], [], 0
        return _as_pairs(group["node"], _forest([*kept, *_flat(waiting)], group)[0])

    return compare


def _forest(parts: list[tuple[np.ndarray, np.ndarray]], group: Group) -> tuple[np.ndarray, np.ndarray]:
    pairs, similar = (np.concatenate(p) for p in zip(*parts, strict=True))
    kept = _spanning(pairs, similar, group["root"])
    return pairs[kept], similar[kept]


def _near_of(shape: HyperMinHash) -> Callable[[Group], Group]:
    """The nodes of a group that have a near pair in it, dealt anew to pairs of blocks of `text_block` nodes."""

    def compare(group: Group) -> Group:
        chosen = np.zeros(len(group["node"]), bool)
        for i, at, _ in _near_pairs(group, shape):
            chosen[i] = True
            chosen[at] = True
        x, y = int(group["x"][0]), int(group["y"][0])
        parts = {}
        for block in {x, y}:
            of_block = np.flatnonzero(chosen & (group["block"] == block))
            cuts = range(shape.text_block, len(of_block), shape.text_block)
            parts[block] = [(block * MOST_PARTS + k, part) for k, part in enumerate(np.split(of_block, cuts))]
        dealt = [
            (a, b, own, nodes)
            for a, first in parts[x]
            for b, second in parts[y]
            if a <= b
            for own, nodes in ({a: first, b: second}).items()
        ]
        at = np.concatenate([nodes for *_, nodes in dealt])
        new = {c: np.concatenate([np.full(len(d[3]), d[k]) for d in dealt]) for k, c in enumerate(("x", "y", "block"))}
        return {**{c: group[c][at] for c in ("key", "node", "root")}, **new}

    return compare


def _links_of(shape: HyperMinHash) -> Callable[[Group], Group]:
    """Near pairs of a group whose full sets are similar enough; one link joins two components for good."""

    def compare(group: Group) -> Group:
        [(pairs, similar)] = _flat(list(_near_pairs(group, shape)))
        texts = [t.encode() for t in group["text"]]
        doc, value = shingle_sets(split_words(texts, NOT_BLANK), shape.shingle)
        kinds, place = np.unique(value, return_inverse=True)
        sets = np.split(place, np.searchsorted(doc, np.arange(1, len(texts))))
        marked = np.zeros(len(kinds), bool)
        last = -1

        def linked(i: int, j: int) -> bool:
            nonlocal last
            if i != last:
                marked[:] = False
                marked[sets[i]] = True
                last = i
            common = np.count_nonzero(marked[sets[j]])
            return common > 0 and 100 * common >= shape.percent * (len(sets[i]) + len(sets[j]) - common)

        return _as_pairs(group["node"], pairs[_spanning(pairs, similar, group["root"], linked)])

    return compare


def _spanning(pairs: np.ndarray, similar: np.ndarray, root: np.ndarray, linked=None) -> list[int]:
    """Pairs that join components which earlier ones left apart: likeliest first, or those that are `linked`."""
    parent = {r: r for r in root.tolist()}

    def top(r: int) -> int:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    kept = []
    order = range(len(pairs)) if linked else np.argsort(-similar, kind="stable").tolist()
    for k in order:
        i, j = pairs[k].tolist()
        a, b = top(int(root[i])), top(int(root[j]))
        if a != b and (linked is None or linked(i, j)):
            parent[a] = b
            kept.append(k)
    return kept
