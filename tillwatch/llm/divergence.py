"""How far the sources of a language diverge in their words.

Terms that enough documents of a language hold are kept and cut into segments.
Each task holds one segment of one language for one pair of source blocks. There the
counts of every source form a segment tree over the term ids; trees are hash-consed,
so equal subtrees of all sources are one node. Two trees are walked at the same time
and a pair of nodes that comes up again is priced once. Partial prices add up per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.text import split_words, text_chunks, written

LETTERS = np.zeros(256, bool)
LETTERS[ord("a") : ord("z") + 1] = True
LETTERS[128:] = True

COUNTS = "lang string, source string, term string, n long, docs long"


@dataclass(frozen=True)
class Audit:
    """Shape of the audit; `segment` and `block` bound a task to `2 * block * segment` counts."""

    least_docs: int = 10
    prior: int = 2  # added to every count
    unit: int = 1_000_000_000  # shares are in this fraction
    top: int = 10
    segment: int = 4096
    block: int = 64
    chunk_bytes: int = 8 << 20


def term_counts(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term. Nulls count as ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, limit=audit.chunk_bytes):
            pairs = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"]).to_pylist()
            names = sorted({(p["lang"], p["source"]) for p in pairs})
            place = {name: i for i, name in enumerate(names)}
            group = np.asarray([place[p["lang"], p["source"]] for p in pairs], np.int64)
            words = split_words(texts, LETTERS)
            order = np.lexsort((words.doc, words.hash, group[words.doc]))
            doc, value, of = words.doc[order], words.hash[order], group[words.doc][order]
            new = np.ones(len(doc), bool)
            new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
            new_doc = new.copy()
            new_doc[1:] |= doc[1:] != doc[:-1]
            first = np.flatnonzero(new)
            if not len(first):
                continue
            n = np.diff(np.append(first, len(doc)))
            held = np.add.reduceat(new_doc.astype(np.int64), first)
            data = words.data.tobytes()
            terms = [data[s:e].decode() for s, e in zip(words.start[order[first]].tolist(), words.end[order[first]].tolist(), strict=True)]
            lang, source = (pa.array([name[k] for name in names], pa.string()).take(pa.array(of[first])) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [lang, source, pa.array(terms, pa.string()), pa.array(n), pa.array(held)], [c.split()[0] for c in COUNTS.split(", ")]
            )

    counted = _plain(docs).mapInArrow(run, COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def divergence(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """Per group of `lang` and `source`: part `pair` prices each other source, part `term` its own top terms.

    Columns lang, source, part, item, value, rank. With V kept terms and N of their
    occurrences in a group, a term's share is `1 + floor(unit * (count + prior) / (N +
    prior * V))`; two shares p and q cost `floor((p - q)^2 / (p + q))`. A pair's value is
    the cost summed over the language's kept terms (0 without any), a term's value its
    cost against the language as a whole. Null lang, source or text count as ''; a group
    without any term takes part with counts of 0; equal rows are documents of their own;
    ties are ranked by item; an empty table gives no rows. Texts of any length are read
    whole; other columns are ignored.
    """
    groups = written(_plain(docs).select("lang", "source").distinct(), "groups")
    counts = written(term_counts(docs, audit), "term-counts")
    kept, langs = _kept(counts, audit)
    entries = written(
        counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total", "segment", "id"), "entries"
    )
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    sized = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    first = Window.partitionBy("lang").orderBy("source")
    sized = written(
        sized.select(
            "lang", "source", F.coalesce("n_group", F.lit(0)).alias("n_group"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_lang", "v")],
            F.coalesce("segments", F.lit(0)).alias("segments"), (F.row_number().over(first) - 1).alias("place"),
        ),
        "sized-groups",
    )
    return _pair_rows(_priced(entries, sized, kept, audit), sized).unionByName(_term_rows(entries, sized, audit))


def _kept(counts: DataFrame, audit: Audit) -> tuple[DataFrame, DataFrame]:
    """(lang, term, total, segment, id) of the kept terms, common ones first within their segment; totals by lang."""
    of_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    terms = written(of_term.filter(F.col("docs") >= audit.least_docs).drop("docs"), "kept-terms")
    langs = terms.groupBy("lang").agg(F.sum("total").alias("n_lang"), F.count(F.lit(1)).alias("v"))
    langs = written(langs.withColumn("segments", F.ceil(F.col("v") / audit.segment).cast("int")), "langs")
    dealt = terms.join(langs.select("lang", "segments"), "lang").withColumn("segment", F.pmod(F.xxhash64("term"), "segments").cast("int"))
    # Rare terms lie together, where subtrees of few small counts repeat.
    place = Window.partitionBy("lang", "segment").orderBy(F.desc("total"), "term")
    return written(dealt.select("lang", "term", "total", "segment", (F.row_number().over(place) - 1).alias("id")), "segments"), langs


def _share(count: Column, n: Column, v: Column, audit: Audit) -> Column:
    """Exact for any count: decimals hold the product."""
    total = (n + v * audit.prior).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", (count + audit.prior).cast("decimal(20,0)") * F.lit(audit.unit).cast("decimal(10,0)"), total)


def _priced(entries: DataFrame, sized: DataFrame, kept: DataFrame, audit: Audit) -> DataFrame:
    """(lang, a, b, value) for places a < b of sources, summed over the segments."""
    own = F.floor(F.col("place") / audit.block).cast("int")
    top = Window.partitionBy("lang")
    placed = sized.withColumn("blocks", F.floor(F.max("place").over(top) / audit.block).cast("int") + 1).withColumn("own", own)
    # A source's rows go to every pair of blocks that its block is part of.
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "source", "place", "n_group", "v", "segments", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")
    )
    in_segment = kept.groupBy("lang", "segment").agg(F.count(F.lit(1)).cast("int").alias("terms"))
    heads = dealt.join(in_segment, "lang").select(
        "lang", "segment", "x", "y", "place", F.lit(-1).alias("id"), F.col("n_group").alias("n"), "v", "terms"
    )
    cells = entries.join(dealt.select("lang", "source", "place", "x", "y"), ["lang", "source"]).select(
        "lang", "segment", "x", "y", "place", "id", "n", F.lit(0).cast("long").alias("v"), F.lit(0).alias("terms")
    )
    parts = heads.unionByName(cells).groupBy("lang", "segment", "x", "y")
    priced = parts.applyInArrow(lambda key, table: _segment_prices(key, table, audit), "lang string, a int, b int, value long")
    return priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _segment_prices(key: tuple, table: pa.Table, audit: Audit) -> pa.Table:
    place, at, n = (table.column(c).to_numpy() for c in ("place", "id", "n"))
    head = at < 0
    terms, v = int(table.column("terms").to_numpy().max()), int(table.column("v").to_numpy().max())
    sources, where = np.unique(place[head], return_index=True)
    totals = n[head][where].tolist()
    counts = np.zeros((len(sources), terms), np.int64)
    counts[np.searchsorted(sources, place[~head]), at[~head]] = n[~head]
    forest = Forest(counts)
    x, y = key[2].as_py(), key[3].as_py()
    rows = []
    for i, a in enumerate(sources.tolist()):
        p = shares(forest.leaves, totals[i], v, audit)
        for j in range(i + 1, len(sources)):
            b = int(sources[j])
            if (a // audit.block, b // audit.block) == (x, y):
                rows.append((a, b, forest.price(i, j, p, shares(forest.leaves, totals[j], v, audit))))
    a, b, value = (np.asarray([r[k] for r in rows], np.int64) for k in range(3))
    lang = pa.array([key[0].as_py()] * len(rows), pa.string())
    return pa.Table.from_arrays([lang, pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(value)], ["lang", "a", "b", "value"])


def shares(counts: np.ndarray, n: int, v: int, audit: Audit = Audit()) -> np.ndarray:
    """Share of each count, exact; the padding's count of -1 gets 0."""
    total = n + audit.prior * v
    if len(counts) and (int(counts.max()) + audit.prior) * audit.unit >= 1 << 63:
        out = np.asarray([1 + audit.unit * (c + audit.prior) // total for c in counts.tolist()], np.int64)
    else:
        out = 1 + audit.unit * (counts + audit.prior) // total
    return np.where(counts < 0, 0, out)


class Forest:
    """Hash-consed segment trees, one per row of a table of counts.

    `level[0]` holds leaf nodes, each a distinct count; a node of a later level is a
    distinct pair of nodes of the level below, whichever tree it occurs in.
    """

    def __init__(self, counts: np.ndarray) -> None:
        rows, width = counts.shape
        size = 1 << max(0, width - 1).bit_length()
        padded = np.full((rows, size), -1, np.int64)
        padded[:, :width] = counts
        self.leaves, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        self.children: list[np.ndarray] = []  # of each level above the leaves: left and right child by node
        while nodes.shape[1] > 1:
            kinds = int(nodes.max()) + 1
            both, above = np.unique(nodes[:, 0::2] * kinds + nodes[:, 1::2], return_inverse=True)
            self.children.append(np.stack([both // kinds, both % kinds], 1))
            nodes = above.reshape(rows, -1)
        self.roots = nodes[:, 0]

    def price(self, i: int, j: int, p: np.ndarray, q: np.ndarray) -> int:
        """Cost of tree `i` against tree `j`, with the shares of their leaves.

        Both trees are walked down together, level by level; equal pairs of nodes
        are one pair from there on, so each is priced once on the way up.
        """
        left, right = self.roots[[i]], self.roots[[j]]
        steps = []
        for children in reversed(self.children):
            below_left, below_right = children[left].ravel(), children[right].ravel()
            width = int(below_right.max()) + 1
            kinds, where = np.unique(below_left * width + below_right, return_inverse=True)
            steps.append(where)
            left, right = kinds // width, kinds % width
        p, q = p[left], q[right]
        total = p + q
        cost = np.where(total > 0, (p - q) * (p - q) // np.maximum(total, 1), 0)
        for where in reversed(steps):
            cost = cost[where].reshape(-1, 2).sum(1)
        return int(cost[0])


def _pair_rows(priced: DataFrame, sized: DataFrame) -> DataFrame:
    """Every other source of each group's language; the output itself is all pairs, as asked for."""
    own = sized.select("lang", "source", F.col("place").alias("own"))
    other = sized.select("lang", F.col("source").alias("item"), F.col("place").alias("other"))
    pairs = own.join(other, "lang").filter("own <> other")
    pairs = pairs.select("lang", "source", "item", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    valued = pairs.join(priced, ["lang", "a", "b"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    return _ranked(valued, "pair")


def _term_rows(entries: DataFrame, sized: DataFrame, audit: Audit) -> DataFrame:
    with_totals = entries.join(sized, ["lang", "source"])
    p = _share(F.col("n"), F.col("n_group"), F.col("v"), audit)
    q = _share(F.col("total"), F.col("n_lang"), F.col("v"), audit)
    shared = with_totals.select("lang", "source", F.col("term").alias("item"), "n", p.alias("p"), q.alias("q"))
    above = shared.filter("n > 0 and p > q").withColumn("value", F.expr("((p - q) * (p - q)) div (p + q)"))
    return _ranked(above, "term").filter(F.col("rank") <= audit.top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.row_number().over(order).alias("rank"))
