"""Benchmark decontamination by winnowing.

Both sides keep the smallest k-gram hash of every window of `window - k + 1`
hashes, so any shared run of `window` words shares a fingerprint. Fingerprints of
the benchmark go to every task, in blocks of bounded size; a document's equal
fingerprints are extended to all windows around them, and those are compared word
for word. Documents are read once per block and never shuffled; only with more
than one block are the short result rows merged by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.text import LETTERS_DIGITS, split_words, text_chunks, written

WINDOW = 10
GRAM = 5
BLOCK_BYTES = 2 << 20  # text of the benchmark that a task holds at once


def winnow(hashes: np.ndarray, valid: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Positions of the smallest hash (the last one of equals) in every window of `width` valid hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[:n].copy(), np.arange(n)
    for j in range(1, width):
        other = hashes[j : j + n]
        less = other <= best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + j
    whole = valid[:n] & valid[width - 1 : width - 1 + n] & (doc[:n] == doc[width - 1 : width - 1 + n])
    at = at[whole]
    return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


@dataclass
class BenchmarkBlock:
    """Fingerprints and exact windows of some items; by window length, sorted by hash."""

    fingerprints: np.ndarray
    windows: dict[int, np.ndarray]  # length -> sorted distinct window hashes
    phrases: dict[int, list[dict[bytes, list[int]]]]  # length -> per hash: words -> item numbers

    @classmethod
    def of(cls, texts: list[str | None], window: int, gram: int) -> BenchmarkBlock:
        words = split_words([(t or "").encode() for t in texts], LETTERS_DIGITS)
        sizes = words.count()
        prints = words.gram_hash(gram)
        at = winnow(prints, words.gram_valid(gram), words.doc, window - gram + 1)
        found: dict[int, dict[int, dict[bytes, list[int]]]] = {}
        for item, size in enumerate(sizes.tolist()):
            length = min(size, window)
            for i in range(int(words.first[item]), int(words.first[item + 1]) - length + 1) if length else ():
                phrase = words.phrase(i, length)
                value = int(_window_hash(words, np.asarray([i]), length)[0])
                items = found.setdefault(length, {}).setdefault(value, {}).setdefault(phrase, [])
                if not items or items[-1] != item:
                    items.append(item)
        windows = {k: np.sort(np.fromiter(v, np.uint64, len(v))) for k, v in found.items()}
        phrases = {k: [found[k][h] for h in windows[k].tolist()] for k in windows}
        return cls(np.unique(prints[at]), windows, phrases)


def _window_hash(words, at: np.ndarray, length: int) -> np.ndarray:
    total = np.full(len(at), length, np.uint64)
    for j in range(length):
        total = (total + words.hash[at + j]) * np.uint64(0x9E3779B97F4A7C15)
    return total


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Index of each value in sorted `among`, or -1."""
    if not len(among) or not len(values):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return np.where(among[at] == values, at, -1)


def find_overlaps(
    texts: list[bytes], block: BenchmarkBlock, window: int = WINDOW, gram: int = GRAM
) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[int]]]:
    """Per text: number of words, merged spans of hit words, numbers of the items found."""
    words = split_words(texts, LETTERS_DIGITS)
    sizes = words.count()
    hits: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[int]] = {}

    def confirm(starts: np.ndarray, length: int) -> None:
        index = _member(_window_hash(words, starts, length), block.windows[length])
        for i, k in zip(starts[index >= 0].tolist(), index[index >= 0].tolist(), strict=True):
            found = block.phrases[length][k].get(words.phrase(i, length))
            if found:
                doc = int(words.doc[i])
                hits.setdefault(doc, []).append((i - int(words.first[doc]), length))
                items.setdefault(doc, set()).update(found)

    for length in block.windows:
        if length < window:  # items that are one short window: every position is a fingerprint
            confirm(np.flatnonzero(words.gram_valid(length)), length)
    if window in block.windows:
        prints = words.gram_hash(gram)
        at = winnow(prints, words.gram_valid(gram), words.doc, window - gram + 1)
        at = at[_member(prints[at], block.fingerprints) >= 0]
        around = np.unique((at[:, None] - np.arange(window - gram + 1)).ravel())
        around = around[(around >= 0) & (around + window <= len(words.doc))]
        confirm(around[words.doc[around] == words.doc[around + window - 1]], window)
    spans = [_merged(hits.get(d, [])) for d in range(len(texts))]
    return sizes, spans, [sorted(items.get(d, ())) for d in range(len(texts))]


def _merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for start, length in sorted(found):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], start + length))
        else:
            spans.append((start, start + length))
    return spans


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list]:
    """Items in groups of at most `limit` bytes of text (or one item), streamed to the driver."""
    held, size = [], 0
    chosen = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    for row in chosen.toLocalIterator():
        length = len(row.text or "")
        if held and size + length > limit:
            yield held
            held, size = [], 0
        held.append(row)
        size += length
    yield held


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    prefix: str = "",
) -> DataFrame:
    """All columns of `docs` and, with `prefix`: n_words, spans of hit words, items found (as text).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A
    word is hit inside any occurrence of `window` consecutive words of an item, or of
    a whole item that has fewer. Null and empty texts have no words and no hits;
    items without words occur nowhere; an empty benchmark hits nothing. Rows of
    `docs` stay as they are, repeated ones too. Spans are [start, end) in words.
    """
    if not 1 <= gram <= window:
        raise ValueError("need 1 <= gram <= window")
    names = [f"{prefix}n_words", f"{prefix}spans", f"{prefix}items"]
    if clash := {c.lower() for c in docs.columns} & {n.lower() for n in names}:
        raise ValueError(f"choose another prefix: {sorted(clash)} are taken")
    marked = None
    for items in _blocks(benchmark, block_bytes):
        marked = _mark(docs if marked is None else written(marked, "contamination"), items, names, window, gram)
    return marked


MARKS = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"


def _mark(docs: DataFrame, rows: list, names: list[str], window: int, gram: int) -> DataFrame:
    """Add or extend the marks with the items of one block."""
    block = BenchmarkBlock.of([r.text for r in rows], window, gram)
    shared = docs.sparkSession.sparkContext.broadcast((block, [r.item_id for r in rows]))
    before = docs.columns[-3:] == names
    plain = docs.columns[:-3] if before else docs.columns
    none = F.lit(None)
    added = docs if before else docs.select("*", *[none.cast(f.dataType).alias(n) for f, n in zip(_marks(docs), names, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids = shared.value
        for batch, texts in text_chunks(batches):
            sizes, spans, items = find_overlaps(texts, block, window, gram)
            found = [{ids[i] for i in x} - {None} for x in items]
            if before:
                old_spans, old_items = batch.column(names[1]).to_pylist(), batch.column(names[2]).to_pylist()
                spans = [
                    _merged([*((s, e - s) for s, e in x), *((y["start"], y["end"] - y["start"]) for y in old)])
                    for x, old in zip(spans, old_spans, strict=True)
                ]
                found = [x.union(old) for x, old in zip(found, old_items, strict=True)]
            marks = [sizes, [[{"start": s, "end": e} for s, e in x] for x in spans], [sorted(x) for x in found]]
            kinds = [batch.schema.field(n).type for n in names]
            columns = [*batch.columns[: len(plain)], *map(pa.array, marks, kinds)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return added.mapInArrow(run, added.schema)


def _marks(docs: DataFrame) -> list:
    return docs.sparkSession.createDataFrame([], MARKS).schema.fields
