"""Spelling variants: words one edit apart, found in frequency-vector tries.

A word's vector counts its letters by letter group. One edit raises at most one group
and lowers at most one, so near words have vectors within a surplus and a deficit of
one. A trie branches on one group's count after the other. Its first levels deal words
to tasks: a word looks in its own subtrie and in those that its budget still reaches.
There a depth-first search spends the rest of the budget, and words at the leaves are verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.text import LOWER, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = LOWER.tobytes()


@dataclass(frozen=True)
class Variants:
    """`groups` letter groups (code point modulo that number); the first `top` levels deal words to tasks.

    A subtrie or its searches of more than `block` words are cut into blocks of about that many.
    """

    least_points: int = 5
    least_count: int = 3
    noise: int = 97  # of so many runs of a document one loses a letter
    times: int = 2  # a form is at least so many times as frequent
    groups: int = 16
    top: int = 4
    block: int = 200_000


def word_counts(docs: DataFrame, shape: Variants = Variants()) -> DataFrame:
    """(word, n) of runs of letters, A-Z lower-cased, with the letters that the noise deletes left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seed = zlib.crc32(f"{doc_id}:".encode())
                runs = Counter(RUN.findall(text.encode().translate(_LOWER).decode()))
                for word, n in runs.items():
                    if len(word) >= shape.least_points:
                        h = zlib.crc32(word.encode(), seed)
                        if h % shape.noise == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < shape.least_points:
                                continue
                        held[word] += n
                if len(held) > 200_000:
                    yield _counted(held)
                    held.clear()
        if held:
            yield _counted(held)

    plain = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = plain.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= shape.least_count)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def spelling_forms(docs: DataFrame, shape: Variants = Variants()) -> DataFrame:
    """Per distinct word: word, form, root, n, n_near, form_n.

    `form` is the near word (one letter inserted, deleted or replaced) with the largest
    n, ties by code point order, if its n is at least `times` the word's own, else null;
    `root` follows forms to the last one. Null texts have no words, a null doc_id counts
    as ''; repeated rows count each; texts and words of any length are read whole; an
    empty table gives no rows; other columns are ignored.
    """
    words = written(word_counts(docs, shape), "words")
    pairs = written(near_words(words, shape), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near"))).alias("best")
    found = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    near_n = -F.col("best.order")
    frequent = near_n >= F.col("n") * shape.times
    forms = written(
        words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, near_n).alias("form_n"),
        ),
        "forms",
    )
    return forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): each round doubles the steps taken; counts double along a chain, so rounds are few."""
    reached = written(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        onward = reached.filter("root <> word").select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        stepped = written(stepped, "roots")
        reached = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return reached


def near_words(words: DataFrame, shape: Variants = Variants()) -> DataFrame:
    """Pairs (a, b) of distinct words that differ by one edit, each once; `b` is not shorter."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("word")
            if not len(column):
                continue
            above = vectors(column.to_pylist(), shape.groups)[:, : shape.top]
            own = subtrie_keys(above)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([False] * len(own)), column], ["key", "probe", "word"])
            # A longer or equal word may have one more in a group and one less in another.
            for raised in range(-1, shape.top):
                for lowered in range(-1, shape.top):
                    if raised == lowered and raised >= 0:
                        continue
                    there = above.copy()
                    if raised >= 0:
                        there[:, raised] += 1
                    if lowered >= 0:
                        there[:, lowered] -= 1
                    reached = (there >= 0).all(1)
                    keys = subtrie_keys(there[reached])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.binary()), pa.array([True] * len(keys), pa.bool_()), column.filter(pa.array(reached))], ["key", "probe", "word"]
                    )

    dealt = words.select("word").mapInArrow(place, "key binary, probe boolean, word string")
    sizes = dealt.groupBy("key").agg(F.count_if(~F.col("probe")).alias("members"), F.count_if("probe").alias("probes"))
    blocks = sizes.filter("members > 0").select(
        "key", *[F.ceil(F.col(c) / shape.block).cast("int").alias(f"{c}_blocks") for c in ("members", "probes")]
    )
    # Members of a big subtrie meet every block of its searches, and the other way round.
    own_blocks, other_blocks = (F.when(F.col("probe"), F.col(a)).otherwise(F.col(b)) for a, b in (("probes_blocks", "members_blocks"), ("members_blocks", "probes_blocks")))
    cut = dealt.join(blocks, "key").select(
        "key", "probe", "word", F.pmod(F.xxhash64("word"), own_blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), other_blocks - 1)).alias("other")
    )
    x, y = F.when(F.col("probe"), F.col("other")).otherwise(F.col("own")), F.when(F.col("probe"), F.col("own")).otherwise(F.col("other"))
    groups = cut.select("key", x.alias("x"), y.alias("y"), "probe", "word").groupBy("key", "x", "y")
    return groups.applyInArrow(lambda table: _pairs_of(table, shape), "a string, b string")


def vectors(words: list[str], groups: int) -> np.ndarray:
    """Letters of each word by group."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(word * groups + points % groups, minlength=len(words) * groups).reshape(len(words), groups)


def subtrie_keys(above: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(above, "<u4")]


def _pairs_of(table: pa.Table, shape: Variants) -> pa.Table:
    probe = table.column("probe").combine_chunks()
    words = table.column("word").combine_chunks()
    members, probes = words.filter(pc.invert(probe)).to_pylist(), words.filter(probe).to_pylist()
    pairs = list(Trie(members, shape.groups).search(probes)) if members and probes else []
    return pa.Table.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["a", "b"])


_UP = np.cumprod(np.full(25, 0x9E3779B97F4A7C15, np.uint64))
_DOWN = np.cumprod(np.concatenate([[np.uint64(1)], np.full(25, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)]))


class Letters:
    """Words as rows of code points, padded with zeros; `wide` ones do not fit and are compared one by one."""

    WIDTH = 24

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.size = np.asarray([len(w) for w in words], np.int64)
        self.rows = np.zeros((len(words), self.WIDTH + 1), np.uint32)
        self.wide = self.size > self.WIDTH
        fits = np.flatnonzero(~self.wide)
        points = np.frombuffer("".join([words[i] for i in fits.tolist()]).encode("utf-32-le"), np.uint32)
        self.rows[np.repeat(fits, self.size[fits]), _places(self.size[fits])] = points
        # Hashes of both halves; and of those that a word one letter shorter would have.
        sums = np.zeros((len(words), self.WIDTH + 2), np.uint64)
        np.cumsum(self.rows * _UP[None, :], axis=1, out=sums[:, 1:])
        self.halves = self._halves(sums, 0)
        self.short_halves = self._halves(sums, 1)

    def _halves(self, sums: np.ndarray, dropped: int) -> tuple[np.ndarray, np.ndarray]:
        every, size = np.arange(len(self.size)), np.minimum(self.size, self.WIDTH)
        head = np.maximum(size - dropped, 0) // 2
        tail = size - (np.maximum(size - dropped, 0) - head)  # where the second half begins
        begin = sums[every, tail]
        return sums[every, head], (sums[every, size] - begin) * _DOWN[tail]


def _places(size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)


def edited(a: Letters, i: np.ndarray, b: Letters, j: np.ndarray) -> np.ndarray:
    """Which words `b[j]` are `a[i]` with one letter inserted, or replaced to come later in order."""
    out = np.zeros(len(i), bool)
    wide = a.wide[i] | b.wide[j]
    for k in np.flatnonzero(wide).tolist():
        x, y = a.words[i[k]], b.words[j[k]]
        out[k] = (len(y) > len(x) or y > x) and one_edit(x, y)
    # One edit leaves a half as it was.
    same = a.size[i] == b.size[j]
    half = np.zeros(len(i), bool)
    for k in (0, 1):
        half |= a.halves[k][i] == np.where(same, b.halves[k][j], b.short_halves[k][j])
    near = np.flatnonzero(half & ~wide)
    left, right = a.rows[i[near]], b.rows[j[near]]
    differ = left != right
    first = differ.argmax(1)
    every = np.arange(len(near))
    longer = b.size[j[near]] - a.size[i[near]]
    replaced = (longer == 0) & (differ.sum(1) == 1) & (right[every, first] > left[every, first])
    # From the first difference on, the longer word goes on as the shorter one, a place later.
    before = np.arange(Letters.WIDTH)[None, :] < first[:, None]
    inserted = (longer == 1) & ((left[:, :-1] == right[:, 1:]) | before).all(1)
    out[near] = replaced | inserted
    return out


class Trie:
    """Words under the counts of their letter groups, one level a group. A node is a run of the sorted words."""

    def __init__(self, words: list[str], groups: int) -> None:
        counts = vectors(words, groups)
        order = np.lexsort(counts.T[::-1])
        self.letters = Letters([words[i] for i in order.tolist()])
        counts = counts[order]
        self.span = int(counts.max()) + 3
        self.levels: list[np.ndarray] = []  # of each level its children as parent * span + count, in order
        node = np.zeros(len(words), np.int64)
        for level in range(groups):
            edges, node = np.unique(node * self.span + counts[:, level], return_inverse=True)
            self.levels.append(edges)
        self.first = np.searchsorted(node, np.arange(len(self.levels[-1]) + 1))

    def search(self, probes: list[str], at_once: int = 1 << 16) -> Iterator[tuple[str, str]]:
        """Pairs (probe, word) one edit apart, where the word is longer, or as long and later in order.

        Many searches go down together; of each level the latest part is taken first
        and cut in half while it is large, so memory is bounded by the depth.
        """
        letters = Letters(probes)
        vector = vectors(probes, len(self.levels))
        zero = np.zeros(len(probes), np.int64)
        # Searches with like vectors go through the same nodes.
        stack = [(0, np.lexsort(vector.T[::-1]), zero, zero.astype(bool), zero.astype(bool))]
        while stack:
            level, probe, node, raised, lowered = stack.pop()
            if len(probe) > at_once:
                half = len(probe) // 2
                stack += [(level, probe[s], node[s], raised[s], lowered[s]) for s in (slice(half), slice(half, None))]
                continue
            if level == len(self.levels):
                # A lower count alone means a shorter word.
                yield from self._verified(letters, probe[raised | ~lowered], node[raised | ~lowered], at_once)
                continue
            edges, want = self.levels[level], vector[probe, level]
            parts = []
            for step, allowed in ((0, None), (1, ~raised), (-1, ~lowered & (want > 0))):
                here = np.arange(len(probe)) if allowed is None else np.flatnonzero(allowed)
                count = want[here] + step
                edge = node[here] * self.span + count
                child = np.minimum(np.searchsorted(edges, edge), len(edges) - 1)
                found = (edges[child] == edge) & (count < self.span)
                here, child = here[found], child[found]
                parts.append((probe[here], child, raised[here] | (step > 0), lowered[here] | (step < 0)))
            below = [np.concatenate(column) for column in zip(*parts, strict=True)]
            if len(below[0]):
                stack.append((level + 1, *below))

    def _verified(self, probes: Letters, probe: np.ndarray, leaf: np.ndarray, at_once: int) -> Iterator[tuple[str, str]]:
        """Words at the leaves that are one edit away, compared in parts of bounded size."""
        size = self.first[leaf + 1] - self.first[leaf]
        cuts = np.searchsorted(np.cumsum(size), np.arange(at_once, int(size.sum()) + at_once, at_once)) + 1
        for part in np.split(np.arange(len(leaf)), cuts):
            i = np.repeat(probe[part], size[part])
            j = np.repeat(self.first[leaf[part]], size[part]) + _places(size[part])
            hit = edited(probes, i, self.letters, j)
            for a, b in zip(i[hit].tolist(), j[hit].tolist(), strict=True):
                yield probes.words[a], self.letters.words[b]


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is replaced, or inserted into `a`, to give `b`."""
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    if len(a) == len(b):
        return at < len(a) and a[at + 1 :] == b[at + 1 :]
    return len(b) == len(a) + 1 and a[at:] == b[at + 1 :]
