"""Language-model scores of documents from a probabilistic suffix tree.

The model predicts the bytes of a text (A-Z lower-cased, words joined by one blank,
then an end symbol) from up to `depth` bytes before. A context stays in the tree if
it is frequent enough and its successors diverge from those of its suffix by a
likelihood-ratio test, or if a longer one in the tree ends with it; probabilities are
smoothed towards the suffix. An absolute count is enough, so the tree grows with the
corpus: contexts above a fixed share (of bounded number) are looked up in the tasks, and
all others where they lie.

Counting is one pass. Partial counts are shuffled as sorted runs, dealt by the `LOW`
bytes before a symbol, so that all longer contexts of a symbol grow in one place: a
bucket's contexts are contiguous ranges of its run. Symbols that need a context below
the share ask by pieces of text, each question once a piece, in the bucket of the
shortest such context; a bucket holds few of these, as each is below the share.

Beside it stands a plain model of words. Its counts grow with the corpus: words
above a fixed share (and so of bounded number) are looked up in the tasks, and all
others by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.text import NOT_BLANK, Words, mix, split_words, text_chunks, written

END, PAD = 0xFE, 0xFF  # bytes that do not occur in UTF-8
TOKEN, GRAM = 0, 1
END_TOKEN = 1  # stands for the end token among word hashes
HELD_COUNTS = 3_000_000
BLOCK = 1 << 15  # symbols that are scored at once: their arrays stay in a core's cache
FILTER_BITS = 1 << 27
LOW = 3  # contexts of up to so many bytes are joined as rows; longer ones grow in their buckets
BUCKET_BITS = 10
ASK_BITS = 8  # of the buckets in which contexts below the share lie: fewer, as a piece of text asks each of them
_FACTOR = 2654435761  # of Fibonacci hashing


@dataclass(frozen=True)
class TreeParams:
    """`least_count`: occurrences that a context needs (or `least_share`, if that is less).

    `least_share`: a context's share of all symbols from which on tasks hold it.
    `frequent_share`: the same of a word among all words.
    """

    depth: int = 7  # at most 7: a context and its successor share 64 bits
    least_count: int = 100
    least_share: float = 5e-6
    frequent_share: float = 5e-7
    deviate: float = 3.09  # of the divergence test: one error in a thousand


@dataclass
class SuffixTree:
    """Contexts held by every task, in the order of their lengths, the empty one first.

    `parent` is a context's suffix, `byte` the byte before that, `unseen` the log10 factor of
    successors not seen after it; `entry` (256 times the context plus the successor, ascending)
    and `log` hold the others. `rare` holds the other contexts of the tree, and `bits` says which
    may be in it. Tables by byte are made where symbols are scored, not on the driver.
    """

    depth: int
    length: np.ndarray
    parent: np.ndarray
    byte: np.ndarray
    unseen: np.ndarray
    entry: np.ndarray
    log: np.ndarray
    bits: np.ndarray | None = None
    rare: DataFrame | None = None

    @cached_property
    def _code(self) -> np.ndarray:
        """Bytes as small numbers; those that no context here has seen share the last one."""
        seen = np.zeros(256, bool)
        seen[self.byte[1:]] = seen[(self.entry & np.uint64(255)).astype(np.int64)] = True
        return np.where(seen, np.cumsum(seen) - 1, seen.sum()).astype(np.int64)

    @cached_property
    def _steps(self) -> tuple[np.ndarray, np.ndarray]:
        """The row of a context among those that go on (0: none does), and by row and code the longer context or 0."""
        row = np.zeros(len(self.parent), np.int64)
        row[self.parent[1:]] = 1
        row = np.cumsum(row) * row
        steps = np.zeros((int(row.max()) + 1, int(self._code.max()) + 1), np.int32)
        steps[row[self.parent[1:]], self._code[self.byte[1:]]] = np.arange(1, len(self.parent))
        return row * steps.shape[1], steps.ravel()

    @cached_property
    def _near(self) -> np.ndarray:
        """The longest context held for each three bytes, as codes with the nearest one first."""
        row, steps = self._steps
        size = int(self._code.max()) + 1
        node, on = np.zeros(1, np.int32), np.ones(1, bool)
        for k in range(min(3, self.depth)):
            deeper = steps[row[node][:, None] + np.arange(size)].ravel()
            on = np.repeat(on, size) & (deeper > 0)
            node = np.where(on, deeper, np.repeat(node, size))
        return node

    @cached_property
    def _logs(self) -> np.ndarray:
        """log10 probabilities by context and code."""
        size = int(self._code.max()) + 1
        logs = np.empty((len(self.parent), size), np.float32)
        cuts = np.searchsorted(self.length, np.arange(self.depth + 2))
        node = (self.entry >> np.uint64(8)).astype(np.int64)
        for i, j in zip(cuts[:-1], cuts[1:]):
            below = logs[self.parent[i:j]] if i else np.full((j - i, size), -math.log10(256))
            logs[i:j] = below + self.unseen[i:j, None]
            mine = slice(*np.searchsorted(node, [i, j]))
            logs[node[mine], self._code[(self.entry[mine] & np.uint64(255)).astype(np.int64)]] = self.log[mine]
        return logs

    @property
    def child(self) -> np.ndarray:
        """`child[s, c]`: the context c + s, or -1; contexts of full depth have no row."""
        child = np.full((max(1, int((self.length < self.depth).sum())), 256), -1, np.int32)
        child[self.parent[1:], self.byte[1:]] = np.arange(1, len(self.parent))
        return child

    @property
    def log_p(self) -> np.ndarray:
        """`log_p[s, x]`: log10 probability of x after s."""
        return self._logs[:, self._code]

    def score(self, padded: np.ndarray, at: np.ndarray, ask: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each symbol from its longest context held here; lengths of that context.

        The last lengths are those up to which `rare` may have longer ones, if `ask` wants to know.
        """
        code = self._code[padded]
        blocks = [self._score(padded, code, at[i : i + BLOCK], ask) for i in range(0, max(1, len(at)), BLOCK)]
        return tuple(np.concatenate(b) for b in zip(*blocks))

    def _score(self, padded: np.ndarray, code: np.ndarray, at: np.ndarray, ask: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, steps = self._steps
        size = int(self._code.max()) + 1
        near = min(3, self.depth)
        place = np.zeros(len(at), np.int64)
        for k in range(1, near + 1):
            place = place * size + code[at - k]
        node = self._near[place]
        active = np.flatnonzero(self.length[node] == near)
        for k in range(near + 1, self.depth + 1):
            deeper = steps[row[node[active]] + code[at[active] - k]]
            on = deeper > 0
            active = active[on]
            node[active] = deeper[on]
        length = self.length[node]
        longest = length.copy()
        if ask and self.bits is not None:
            active = np.flatnonzero(length < self.depth)
            k = length[active] + 1
            context = _gram_keys(padded, at[active], self.depth) >> np.uint64(8)
            while len(active):
                bit = _bit_of(context & _MASKS[k] | k.view(np.uint64) << np.uint64(56))
                known = self.bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 > 0
                longest[active[known]] += 1
                on = known & (k < self.depth)
                active, context, k = active[on], context[on], k[on] + 1
        return self._logs.ravel()[node * np.int64(size) + code[at]], length, longest


_MASKS = np.asarray([(1 << 8 * k) - 1 for k in range(8)], np.uint64)


def _pair(node: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return node.astype(np.uint64) << np.uint64(8) | byte.astype(np.uint64)


def symbols(words: Words, n: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as symbols with `depth` pads before each: array, places of symbols, first symbol per text."""
    lengths = words.end - words.start + 1
    kept = np.zeros(len(words.data) + 1, bool)
    kept[: len(words.data)] = NOT_BLANK[words.data]
    kept[words.end] = True
    data = np.append(words.data, np.uint8(0))
    data[words.end] = 0x20
    some = np.flatnonzero(words.count() > 0)
    data[words.end[words.first[some + 1] - 1]] = END
    size = np.ones(n, np.int64)
    sums = np.concatenate([[0], np.cumsum(lengths)])
    size[some] = sums[words.first[some + 1]] - sums[words.first[some]]
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(first[-1]) + np.repeat((np.arange(n) + 1) * depth, size)
    padded = np.full(int(first[-1]) + n * depth, PAD, np.uint8)
    stream = np.full(int(first[-1]), END, np.uint8)
    real = np.repeat(words.count() > 0, size)
    stream[real] = data[kept]
    padded[at] = stream
    return padded, at, first


def _gram_keys(padded: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Symbol in the lowest byte, the one before it in the next, and so on; `at` ascends."""
    if not len(at):
        return np.zeros(0, np.uint64)
    start = int(at[0])
    data = np.concatenate([np.full(7, PAD, np.uint8), padded[max(0, start - 7) : int(at[-1]) + 1]])
    whole = np.ndarray(len(data) - 7, ">u8", data, 0, (1,))[at - max(0, start - 7)]  # eight bytes up to each place
    spare = np.uint64(8 * (7 - depth))
    return whole.astype(np.uint64) << spare >> spare


def _near_first(key: np.ndarray) -> np.ndarray:
    """The nearest byte before a symbol in the highest byte, and so on; the symbol in the lowest."""
    key = key.byteswap()
    return key << np.uint64(8) | key >> np.uint64(56)


def _bucket_of(key: np.ndarray, bits: int = BUCKET_BITS) -> np.ndarray:
    """Bucket of a context, as `_bucket` has it."""
    key = (key ^ key >> np.uint64(24) ^ key >> np.uint64(48)) & np.uint64((1 << 24) - 1)
    return (key * np.uint64(_FACTOR) >> np.uint64(32 - bits)).astype(np.int64) & (1 << bits) - 1


def _bucket(key: Column, bits: int = BUCKET_BITS) -> Column:
    key = key.bitwiseXOR(F.shiftrightunsigned(key, 24)).bitwiseXOR(F.shiftrightunsigned(key, 48))
    folded = key.bitwiseAND(F.lit((1 << 24) - 1)) * F.lit(_FACTOR)
    return F.shiftrightunsigned(folded, 32 - bits).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length as bytes: first all lowest bytes, then the next ones, and so on."""
    planes = [a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(blob: bytes, n: int, *types) -> list[np.ndarray]:
    types = [np.dtype(t) for t in types]
    data, out, at = pa.decompress(blob, n * sum(t.itemsize for t in types), codec="zstd", asbytes=True), [], 0
    for t in types:
        planes = np.frombuffer(data, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(t).ravel())
        at += n * t.itemsize
    return out


def _pack_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)), counts.astype(np.int64))


def _unpack_run(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = _unpack(blob, n, np.uint64, np.int64)
    return np.cumsum(steps, dtype=np.uint64), counts


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their sums of sorted runs."""
    keys, counts = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(keys, kind="stable")
    return _summed(keys[order], counts[order])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lead = _leads(keys)
    return keys[lead], np.add.reduceat(counts, lead) if len(lead) else counts


def _leads(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))


class _Counter:
    """Counts of one kind in a task, as sorted arrays; handed on by buckets when there are too many."""

    def __init__(self, kind: int) -> None:
        self.kind, self.parts, self.held = kind, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > HELD_COUNTS:
            self._merge()
            if self.held > HELD_COUNTS // 2:
                yield from self.flush()

    def _merge(self) -> None:
        self.parts = [_merged(self.parts)]
        self.held = len(self.parts[0][0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self._merge()
            keys, counts = self.parts[0]
            if self.kind == GRAM:
                bucket = _bucket_of(_context(keys >> np.uint64(64 - 8 * LOW), LOW)).astype(np.uint16)
            else:
                bucket = (keys >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            keys, counts, bucket = keys[order], counts[order], bucket[order]
            first = np.append(_leads(bucket), len(bucket))
            rows = [
                (self.kind, int(bucket[i]), int(counts[i:j].sum()), int(j - i), _pack_run(keys[i:j], counts[i:j]))
                for i, j in zip(first[:-1], first[1:])
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), RUN_TYPES)], RUN_NAMES)
        self.parts, self.held = [], 0


def _context(prefix: np.ndarray, length: int) -> np.ndarray:
    """A context with its nearest byte lowest, from one with its nearest byte highest."""
    return (prefix << np.uint64(64 - 8 * length)).byteswap()


RUN = "kind int, key long, n long, size int, run binary"
RUN_NAMES = ["kind", "key", "n", "size", "run"]
RUN_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def corpus_counts(docs: DataFrame, depth: int) -> DataFrame:
    """(kind, key, n, ...): occurrences of word hashes (the end token counted) and of symbols with contexts.

    Symbols come as one row per bucket of `LOW` bytes before them: `run` holds the sorted
    symbols with contexts and their counts, `low` and `low_n` those with `LOW` bytes only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, grams = _Counter(TOKEN), _Counter(GRAM)
        for _, texts in text_chunks(batches):
            words = split_words(texts, NOT_BLANK)
            yield from tokens.add(np.append(words.hash, np.full(len(texts), END_TOKEN, np.uint64)))
            padded, at, _ = symbols(words, len(texts), depth)
            yield from grams.add(_near_first(_gram_keys(padded, at, depth)))
        yield from tokens.flush()
        yield from grams.flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*RUN_NAMES, "low", "low_n"]
        types = [*RUN_TYPES, pa.list_(pa.int64()), pa.list_(pa.int64())]

        def rows(kind: int, bucket: int, parts: list) -> Iterator[pa.RecordBatch]:
            keys, counts = _merged(parts)
            if kind == TOKEN:
                for i in range(0, len(keys), 50_000):
                    n = len(keys[i : i + 50_000])
                    full = [np.full(n, kind, np.int32), keys[i : i + n].view(np.int64), counts[i : i + n]]
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, full), *[pa.nulls(n, t) for t in types[3:]]], names
                    )
                return
            near = _context(keys >> np.uint64(64 - 8 * LOW), LOW) << np.uint64(8) | keys & np.uint64(255)
            order = np.argsort(near)
            low, low_n = _summed(near[order], counts[order])
            row = [kind, bucket, int(counts.sum()), len(keys), _pack_run(keys, counts), low.view(np.int64), low_n]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        last, parts = None, []
        for batch in batches:
            kinds, keys, sizes = (batch.column(c).to_numpy() for c in ("kind", "key", "size"))
            for i, blob in enumerate(batch.column("run")):
                if last != (kinds[i], keys[i]):
                    if parts:
                        yield from rows(*last, parts)
                    last, parts = (int(kinds[i]), int(keys[i])), []
                parts.append(_unpack_run(blob.as_py(), int(sizes[i])))
        if parts:
            yield from rows(*last, parts)

    text = docs.select(F.col("text").cast("string").alias("text"))
    partial = text.mapInArrow(run, RUN).repartition("kind", "key").sortWithinPartitions("kind", "key")
    return partial.mapInArrow(merge, f"{RUN}, low array<long>, low_n array<long>")


def fit_tree(counts: DataFrame, params: TreeParams = TreeParams()) -> SuffixTree:
    """Grow the tree from the counts of symbols with contexts of full depth.

    Contexts of up to `LOW` bytes are counted, tested and smoothed as joins with those of
    their suffixes, longer ones bucket by bucket. Only contexts with at least `least_share` of
    all symbols come to the driver, at most `1 / least_share` per length; the others stay
    in the written table `rare`. With no counts every symbol is equally likely.
    """
    runs = counts.filter(F.col("kind") == GRAM)
    total = runs.agg(F.sum("n")).first()[0] or 0
    often = max(1, math.ceil(total * params.least_share))
    least = min(often, params.least_count)
    low = min(LOW, params.depth)
    grams = runs.select(F.explode(F.arrays_zip("low", "low_n")).alias("g")).select(F.col("g.low").alias("key"), F.col("g.low_n").alias("n"))
    levels = [written(_level(grams, k, least), "contexts") for k in range(low + 1)]
    all_and_kinds = F.col("all") + F.col("kinds")
    p = (F.col("n") + F.col("kinds") / 256) / all_and_kinds
    nodes = [levels[0].select("context", "x", "n", "all", "kinds", p.alias("p"), F.lit(None).cast("long").alias("root"))]
    for k in range(1, low + 1):
        below = nodes[-1].select(F.col("context").alias("suffix"), "x", F.col("p").alias("below"), F.col("root").alias("above"))
        mine = levels[k].withColumn("suffix", _suffix(k)).join(below, ["suffix", "x"])
        p = (F.col("n") + F.col("kinds") * F.col("below")) / all_and_kinds
        root = F.when(F.col("all") < often, F.coalesce("above", F.col("context").bitwiseOR(F.lit(k << 56))))
        nodes.append(written(mine.select("context", "x", "n", "all", "kinds", p.alias("p"), root.alias("root")), "nodes"))
    deep = written(_grown(runs, nodes[low], low, params, least, often), "deep-contexts")
    parts = [_listed(nodes[0], 0)]
    kept = deep.filter(F.col("k") == low + 1).select(_suffix(low + 1).alias("context")).distinct()
    for k in range(low, 0, -1):
        known = _diverging(levels[k], levels[k - 1], k, params.deviate)
        kept = written(known.union(kept).distinct(), "kept")
        parts.append(_listed(nodes[k].join(kept, "context", "left_semi"), k))
        kept = kept.select(_suffix(k).alias("context"))  # suffixes of contexts in the tree
    tree = deep.unionByName(written(reduce(DataFrame.unionByName, parts), "contexts-listed"))
    held = _held(tree.filter("root is null"), params.depth)
    if least < often:
        unseen = F.log10(F.col("kinds") / all_and_kinds)
        key = F.col("context").bitwiseOR(F.shiftleft(F.col("k").cast("long"), 56))
        rare = tree.filter("root is not null").select(
            _bucket(F.col("root"), ASK_BITS).alias("bucket"), key.alias("key"), unseen.alias("unseen"), "xs", "logs"
        )
        held.bits = _filter_of(rare)
        held.rare = rare if held.bits is not None else None
    return held


TREE = "k int, context long, all long, kinds long, root long, xs array<int>, logs array<float>"


def _listed(level: DataFrame, length: int) -> DataFrame:
    """One row per context, with its successors and their log10 probabilities."""
    entry = F.struct(F.col("x").cast("int").alias("x"), F.log10("p").cast("float").alias("log"))
    whole = level.groupBy("context").agg(
        *[F.first(c).alias(c) for c in ("all", "kinds", "root")], F.array_sort(F.collect_list(entry)).alias("s")
    )
    return whole.select(
        F.lit(length).alias("k"), "context", "all", "kinds", "root", F.col("s.x").alias("xs"), F.col("s.log").alias("logs")
    )


@dataclass
class _Level:
    """Contexts of a length in a bucket, ascending by nearest byte first, and their successors."""

    prefix: np.ndarray
    all: np.ndarray
    kinds: np.ndarray
    root: np.ndarray  # -1: none
    entry: np.ndarray  # 256 times the place of the context, plus the successor; ascending
    n: np.ndarray
    p: np.ndarray

    @classmethod
    def of_rows(cls, rows: pa.StructArray, length: int) -> _Level:
        cols = {f.name: rows.field(f.name) for f in rows.type}
        prefix = cols["context"].to_numpy().view(np.uint64).byteswap() >> np.uint64(64 - 8 * length)
        x = cols["x"].to_numpy().astype(np.uint64)
        order = np.lexsort((x, prefix))
        prefix = prefix[order]
        lead = _leads(prefix)
        place = np.cumsum(np.concatenate([[0], prefix[1:] != prefix[:-1]]))
        first = order[lead]
        root = cols["root"].fill_null(-1).to_numpy()[first]
        whole, kinds = cols["all"].to_numpy()[first], cols["kinds"].to_numpy()[first]
        return cls(prefix[lead], whole, kinds, root, _pair(place, x[order]), cols["n"].to_numpy()[order], cols["p"].to_numpy()[order])


def _grown(runs: DataFrame, top: DataFrame, low: int, params: TreeParams, least: int, often: int) -> DataFrame:
    """Contexts of more than `low` bytes that stay in the tree, each bucket on from its contexts of `low` bytes."""

    def deeper(before: _Level, keys: np.ndarray, n: np.ndarray, k: int):
        """The next level, the suffix and the test result of each context, and the symbols that go on."""
        prefix = keys >> np.uint64(64 - 8 * k)
        lead = _leads(prefix)
        whole = np.add.reduceat(n, lead)
        often_enough = np.repeat(whole >= least, np.diff(np.append(lead, len(prefix))))
        keys, n, prefix = keys[often_enough], n[often_enough], prefix[often_enough]
        if not len(keys):
            return None, None, None, keys, n
        lead = _leads(prefix)
        place = np.cumsum(np.concatenate([[0], prefix[1:] != prefix[:-1]]))
        entry = _pair(place, keys & np.uint64(255))
        order = np.argsort(entry, kind="stable")
        entry, count = _summed(entry[order], n[order])
        prefix, whole = prefix[lead], whole[whole >= least]
        of = (entry >> np.uint64(8)).astype(np.int64)
        kinds = np.bincount(of, minlength=len(prefix))
        parent = np.searchsorted(before.prefix, prefix >> np.uint64(8))
        at = np.searchsorted(before.entry, _pair(parent[of], entry & np.uint64(255)))
        expected = before.n[at] / before.all[parent[of]]
        g = 2 * np.bincount(of, count * np.log(count / whole[of] / expected), len(prefix))
        free = np.maximum(1, before.kinds[parent] - 1)
        v = 2 / (9 * free)
        diverging = g > free * (1 - v + params.deviate * np.sqrt(v)) ** 3
        p = (count + kinds[of] * before.p[at]) / (whole + kinds)[of]
        key = _context(prefix, k).view(np.int64) | k << 56
        root = np.where(whole >= often, -1, np.where(before.root[parent] >= 0, before.root[parent], key))
        return _Level(prefix, whole, kinds, root, entry, count, p), parent, diverging, keys, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, n = _unpack_run(batch.column("run")[i].as_py(), batch.column("size")[i].as_py())
                level = _Level.of_rows(batch.column("top")[i].values, low)
                held = np.searchsorted(level.prefix, keys >> np.uint64(64 - 8 * low))
                held[held == len(level.prefix)] = 0
                on = level.prefix[held] == keys >> np.uint64(64 - 8 * low)
                keys, n, grown = keys[on], n[on], []
                for k in range(low + 1, params.depth + 1):
                    level, parent, diverging, keys, n = deeper(level, keys, n, k)
                    if level is None:
                        break
                    grown.append((k, level, parent, diverging))
                above = None
                for k, level, parent, kept in reversed(grown):
                    if above is not None:  # suffixes of contexts in the tree
                        kept[above] = True
                    above = parent[kept]
                    if len(above):
                        yield rows(k, level, kept)

    def rows(k: int, level: _Level, kept: np.ndarray) -> pa.RecordBatch:
        mine = kept[(level.entry >> np.uint64(8)).astype(np.int64)]
        offsets = np.concatenate([[0], np.cumsum(level.kinds[kept])]).astype(np.int32)
        xs = (level.entry[mine] & np.uint64(255)).astype(np.int32)
        logs = np.log10(level.p[mine]).astype(np.float32)
        root = level.root[kept]
        columns = [
            pa.array(np.full(len(root), k, np.int32)),
            pa.array(_context(level.prefix[kept], k).view(np.int64)),
            pa.array(level.all[kept]),
            pa.array(level.kinds[kept]),
            pa.array(root, mask=root < 0),
            *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (xs, logs)],
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in TREE.split(", ")])

    by_bucket = top.groupBy(_bucket(F.col("context")).cast("long").alias("key")).agg(
        F.collect_list(F.struct("context", "x", "n", "all", "kinds", "p", "root")).alias("top")
    )
    return runs.select("key", "size", "run").join(by_bucket, "key").select("size", "run", "top").mapInArrow(run, TREE)


def _held(tree: DataFrame, depth: int) -> SuffixTree:
    """The contexts of a frame, each with all its suffixes, as one tree."""
    found = tree.select("k", "context", "all", "kinds", "xs", "logs").toArrow().combine_chunks()
    if not found.num_rows:
        none = np.zeros(1, np.int64)
        return SuffixTree(depth, none, none, none, np.zeros(1), np.zeros(0, np.uint64), np.zeros(0, np.float32))
    k, context, whole, kinds = (found.column(c).to_numpy() for c in ("k", "context", "all", "kinds"))
    order = np.lexsort((context, k))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    sizes = found.column("xs").combine_chunks().value_lengths().to_numpy()
    xs, logs = (pa.compute.list_flatten(found.column(c)).to_numpy() for c in ("xs", "logs"))
    entry = _pair(np.repeat(place, sizes), xs)
    sorted_ = np.argsort(entry)
    k, context, whole, kinds = k[order].astype(np.int64), context[order], whole[order], kinds[order]
    first = np.searchsorted(k, np.arange(depth + 2))
    parent = np.zeros(len(k), np.int64)
    for i in range(1, depth + 1):
        suffix = context[first[i] : first[i + 1]] & (1 << 8 * (i - 1)) - 1
        parent[first[i] : first[i + 1]] = first[i - 1] + np.searchsorted(context[first[i - 1] : first[i]], suffix)
    byte = context >> 8 * np.maximum(0, k - 1) & 255
    return SuffixTree(depth, k, parent, byte, np.log10(kinds / (kinds + whole)), entry[sorted_], logs[sorted_])


def _level(grams: DataFrame, length: int, least: int) -> DataFrame:
    """(context, x, n, all, kinds) of contexts of a length that occur often enough."""
    mask = (1 << (8 * (length + 1))) - 1 if length < 7 else -1
    level = grams.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n"))
    level = level.select(F.shiftrightunsigned("key", 8).alias("context"), F.col("key").bitwiseAND(255).alias("x"), "n")
    whole = Window.partitionBy("context")  # 256 rows at most
    level = level.withColumns({"all": F.sum("n").over(whole), "kinds": F.count(F.lit(1)).over(whole)})
    return level.filter(F.col("all") >= least)


def _suffix(length: int):
    return F.col("context").bitwiseAND(F.lit((1 << (8 * (length - 1))) - 1))


def _diverging(level: DataFrame, before: DataFrame, length: int, deviate: float) -> DataFrame:
    """Contexts whose successors fail the likelihood-ratio test against those of their suffixes."""
    suffix = before.select(
        F.col("context").alias("suffix"), "x", (F.col("n") / F.col("all")).alias("expected"), F.col("kinds").alias("free")
    )
    joined = level.withColumn("suffix", _suffix(length)).join(suffix, ["suffix", "x"])
    g = 2 * F.sum(F.col("n") * F.log(F.col("n") / F.col("all") / F.col("expected")))
    free = F.greatest(F.lit(1), F.first("free") - 1)
    tested = joined.groupBy("context").agg(g.alias("g"), free.alias("free"))
    v = 2 / (9 * F.col("free"))
    return tested.filter(F.col("g") > F.col("free") * F.pow(1 - v + deviate * F.sqrt(v), F.lit(3.0))).select("context")


def _bit_of(key: np.ndarray) -> np.ndarray:
    return mix(key.astype(np.uint64)) & np.uint64(FILTER_BITS - 1)


def _filter_of(rare: DataFrame) -> np.ndarray | None:
    """A bit per hash of a rare context, of fixed size; None if there are no contexts. Only saves look-ups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = _bit_of(batch.column("key").to_numpy()).astype(np.int64) + 1
            yield pa.RecordBatch.from_arrays([pa.array(bit)], ["bit"])

    marked = rare.select("key").mapInArrow(run, "bit long").groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
    rows = marked.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    if not rows:
        return None
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for row in rows:
        bits[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return bits.ravel()


def _questions(gram: np.ndarray, length: np.ndarray, longest: np.ndarray):
    """Questions of a piece of text by buckets, and which of them each of the given symbols asks.

    A question is a symbol with its context as far as the filter let it go. What tasks hold
    is looked up again where it is answered, as that takes less room than to send it.
    """
    firsts, asks, n = [], np.empty(len(gram), np.int64), 0
    for k in range(1, 8):
        mine = np.flatnonzero(longest == k)
        order = mine[np.argsort(gram[mine])]
        lead = _leads(gram[order])
        firsts.append(order[lead])
        asks[order] = n + np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(order))))
        n += len(lead)
    at = np.concatenate(firsts)
    low = (length[at] + 1).astype(np.uint64)
    root = gram[at] >> np.uint64(8) & (np.uint64(1) << np.uint64(8) * low) - np.uint64(1) | low << np.uint64(56)
    bucket = _bucket_of(root, ASK_BITS)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    at, bucket = at[order], bucket[order]
    high = longest[at].astype(np.uint8)
    cuts = np.append(_leads(bucket), n)
    questions = [
        {"bucket": int(bucket[i]), "size": int(j - i), "blob": _pack(np.diff(gram[at[i:j]], prepend=np.uint64(0)), high[i:j])}
        for i, j in zip(cuts[:-1], cuts[1:])
    ]
    return questions, place[asks]


class _RareContexts:
    """Contexts below the share in one bucket."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(batches)
        key = rows.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sizes = pa.compute.list_value_length(rows.column("xs")).to_numpy()
        xs, logs = (pa.compute.list_flatten(rows.column(c)).to_numpy() for c in ("xs", "logs"))
        entry = _pair(np.repeat(place, sizes), xs)
        at = np.argsort(entry)
        self.key, self.unseen, self.entry, self.log = key[order], rows.column("unseen").to_numpy()[order], entry[at], logs[at]

    def answer(self, gram: np.ndarray, low: np.ndarray, high: np.ndarray, base: np.ndarray) -> np.ndarray:
        # From the shortest context on: a successor seen there has its own probability, another one that of the suffix.
        value = base.astype(np.float64)
        for k in range(1, 8):
            mine = np.flatnonzero((low < k) & (k <= high))
            key = gram[mine] >> np.uint64(8) & np.uint64((1 << 8 * k) - 1) | np.uint64(k << 56)
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            found = self.key[at] == key
            mine, at = mine[found], at[found]
            entry = _pair(at, gram[mine] & np.uint64(255))
            place = np.minimum(np.searchsorted(self.entry, entry), len(self.entry) - 1)
            value[mine] = np.where(self.entry[place] == entry, self.log[place], value[mine] + self.unseen[at])
        return value


def _rare_scores(scored: DataFrame, rare: DataFrame, shared: Broadcast) -> DataFrame:
    """(row_id, rare_score): sums over the symbols whose context goes on below the share.

    A bucket's contexts reach a task before the questions of all pieces of text to it, and
    a piece's symbols before its answers: neither is held whole.
    """
    pieces = scored.filter("asked is not null").select(F.col("row_id").alias("piece"), "questions", "times_asked", "asked")
    asked = pieces.select("piece", F.explode("questions").alias("q")).select("q.bucket", "piece", "q.size", "q.blob")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("key", "long"), ("unseen", "double"), ("xs", "array<int>"), ("logs", "array<float>"))]
    first = rare.select("bucket", F.lit(-1).cast("long").alias("piece"), F.lit(0).alias("size"), F.lit(None).cast("binary").alias("blob"), "key", "unseen", "xs", "logs")
    dealt = first.unionByName(asked.select("*", *nothing)).repartition("bucket").sortWithinPartitions("bucket", "piece")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, gathered, contexts = None, [], None
        for batch in batches:
            buckets, pieces, sizes = (batch.column(c).to_numpy() for c in ("bucket", "piece", "size"))
            cuts = np.append(_leads(buckets.astype(np.int64) << 1 | (pieces >= 0)), len(buckets))
            for i, j in zip(cuts[:-1], cuts[1:]):
                if buckets[i] != bucket:
                    bucket, gathered, contexts = buckets[i], [], None
                if pieces[i] < 0:
                    gathered.append(batch.slice(i, j - i))
                    continue
                if contexts is None and gathered:
                    contexts, gathered = _RareContexts(gathered), []
                blobs = []
                for r in range(i, j):
                    steps, high = _unpack(batch.column("blob")[r].as_py(), int(sizes[r]), np.uint64, np.uint8)
                    gram = np.cumsum(steps, dtype=np.uint64)
                    held = shared.value[0].score(gram.astype(">u8").view(np.uint8), np.arange(7, 8 * len(gram), 8), ask=False)
                    values = held[0] if contexts is None else contexts.answer(gram, held[1], high, held[0])
                    blobs.append(_pack(values.astype(np.float32)))
                columns = [pieces[i:j], buckets[i:j], sizes[i:j]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(blobs, pa.binary())], ["piece", "bucket", "size", "blob"])

    answers = written(dealt.mapInArrow(answer, "piece long, bucket int, size int, blob binary"), "answers")
    leads = pieces.select(
        "piece", F.lit(-1).alias("bucket"), F.lit(0).alias("size"), F.col("asked").alias("blob"), "times_asked"
    )
    answers = answers.withColumn("times_asked", F.lit(None).cast("array<int>"))
    whole = leads.unionByName(answers).repartition("piece").sortWithinPartitions("piece", "bucket")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(piece: int, times: np.ndarray, asks: np.ndarray, values: list) -> pa.RecordBatch:
            sums = np.concatenate([[0.0], np.cumsum(np.concatenate(values)[asks], dtype=np.float64)])
            last = np.cumsum(times)
            ids = np.arange(piece, piece + len(times))
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums[last] - sums[last - times])], ["row_id", "rare_score"])

        piece = None
        for batch in batches:
            pieces, buckets, sizes = (batch.column(c).to_numpy() for c in ("piece", "bucket", "size"))
            for r in range(len(pieces)):
                blob = batch.column("blob")[r].as_py()
                if buckets[r] < 0:
                    if piece is not None:
                        yield rows(piece, times, asks, values)
                    times = np.asarray(batch.column("times_asked")[r].values, np.int64)
                    steps = _unpack(blob, int(times.sum()), np.int32)[0]
                    piece, asks, values = int(pieces[r]), np.cumsum(steps, dtype=np.int64), []
                else:
                    values += _unpack(blob, int(sizes[r]), np.float32)
        if piece is not None:
            yield rows(piece, times, asks, values)

    return whole.mapInArrow(add_up, "row_id long, rare_score double")


SCORED = (
    "row_id long, doc_id long, n_tokens long, known long, common double, score double, "
    "rare array<long>, times array<int>"
)
ASKED = "times_asked array<int>, asked binary, questions array<struct<bucket:int,size:int,blob:binary>>"


def score_documents(docs: DataFrame, held_out, params: TreeParams = TreeParams()) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `held_out` is a condition on the columns of `docs`; where it is true (null
    counts as false) a document is scored but not learnt from. `score` is the
    suffix tree's log10 probability of the text, `base_score` that of words counted
    in the training texts plus one. A null or empty text is just an end token. Rows
    stay apart even if ids repeat; an empty table gives no rows. With nothing to
    learn from, all symbols are equally likely and no word is known.
    """
    flag = F.coalesce(held_out, F.lit(False))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), flag.alias("held_out"))
    counts = written(corpus_counts(chosen.filter("not held_out"), params.depth), "corpus-counts")
    tokens = counts.filter(F.col("kind") == TOKEN).select("key", "n")
    sums = tokens.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, kinds = sums[0] or 0, sums[1]
    tree = fit_tree(counts, params)
    least = max(1, math.ceil(total * params.frequent_share))
    often = tokens.filter(F.col("n") >= least).toPandas()  # at most 1 / frequent_share words
    ends = tokens.filter(F.col("key") == END_TOKEN).agg(F.sum("n")).first()[0] or 0
    keys = often["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    context = docs.sparkSession.sparkContext
    held = replace(tree, rare=None)
    shared = context.broadcast((held, keys[order], np.log10(often["n"].to_numpy()[order] + 1.0), ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, logs, ends = shared.value
        row_id = TaskContext.get().partitionId() << 33
        for batch, texts in text_chunks(batches):
            n = len(texts)
            words = split_words(texts, NOT_BLANK)
            common, known, rare = _known_words(words, n, keys, logs)
            padded, at, first = symbols(words, n, tree.depth)
            log_p, length, longest = tree.score(padded, at)
            on = longest > length
            sums = np.concatenate([[0.0], np.cumsum(np.where(on, 0.0, log_p), dtype=np.float64)])
            score = sums[first[1:]] - sums[first[:-1]]
            gram = _gram_keys(padded, at[on], tree.depth)
            spare = (8 * (7 - longest[on])).astype(np.uint64)  # bytes before the context
            gram = (gram << spare) >> spare
            times = np.diff(np.searchsorted(np.flatnonzero(on), first)).astype(np.int32)
            asked = [None, None, None]
            if len(gram):
                questions, asks = _questions(gram, length[on], longest[on])
                # Sorted within a text: the order does not matter to its sum, and steps take less room.
                asks = np.sort(np.repeat(np.arange(n) << 32, times) | asks) & 0xFFFFFFFF
                asked = [times, _pack(np.diff(asks.astype(np.int32), prepend=np.int32(0))), questions]
            columns = [
                pa.array(np.arange(row_id, row_id + n)),
                batch.column("doc_id"),
                pa.array(words.count() + 1),
                pa.array(known + (ends > 0)),
                pa.array(common + math.log10(ends + 1)),
                pa.array(score),
                *rare,
                *[pa.array([a, *[None] * (n - 1)], t) for a, t in zip(asked, asked_types)],  # on a piece's first row
            ]
            row_id += n
            yield pa.RecordBatch.from_arrays([*columns, batch.column("held_out")], [*names, "held_out"])

    names = [c.split()[0] for c in f"{SCORED}, {ASKED}".split(", ")]
    question = pa.struct([("bucket", pa.int32()), ("size", pa.int32()), ("blob", pa.binary())])
    asked_types = pa.list_(pa.int32()), pa.binary(), pa.list_(question)
    scored = written(chosen.mapInArrow(run, f"{SCORED}, {ASKED}, held_out boolean"), "scored")
    # Words below the share: each is rare by definition, so no key of this join is hot.
    spread = scored.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("r"))
    spread = spread.select("row_id", F.col("r.rare").alias("key"), F.col("r.times").alias("times"))
    few = tokens.filter(F.col("n") < least)
    looked_up = spread.join(few, "key").groupBy("row_id").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("rare_sum"), F.sum("times").alias("rare_known")
    )
    looked_up = written(looked_up, "rare-words")  # so that its shuffle files go before the next ones come
    whole = scored.drop("rare", "times", "times_asked", "asked", "questions").join(looked_up, "row_id", "left")
    score = F.col("score")
    if tree.rare is not None:
        whole = whole.join(written(_rare_scores(scored, tree.rare, shared), "rare-scores"), "row_id", "left")
        score = score + F.coalesce("rare_score", F.lit(0.0))
    per_token = math.log10(total + kinds + 1)
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("common") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        score.alias("score"),
    )


def _known_words(words: Words, n: int, keys: np.ndarray, logs: np.ndarray):
    """Per text: sum of logs and number of frequent words; the others with how often they occur."""
    values, back = np.unique(words.hash, return_inverse=True)
    place = np.minimum(np.searchsorted(keys, values), max(0, len(keys) - 1))
    frequent = (keys[place] == values) if len(keys) else np.zeros(len(values), bool)
    is_common = frequent[back]
    log_of = np.where(frequent, logs[place] if len(keys) else 0.0, 0.0)
    common = np.bincount(words.doc, log_of[back], n)
    known = np.bincount(words.doc[is_common], minlength=n)
    pair = words.doc[~is_common] * len(values) + back[~is_common]
    distinct, times = np.unique(pair, return_counts=True)
    offsets = np.searchsorted(distinct, np.arange(n + 1) * len(values)).astype(np.int32)
    rare = values[distinct % max(1, len(values))].view(np.int64)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (rare, times.astype(np.int32))]
    return common, known, lists
