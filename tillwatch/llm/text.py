"""Words and hashes of whole Arrow batches at once, without a Python loop per word."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillwatch.sources.scratch import scratch_folder

# Word bytes of UTF-8 text, after A-Z became a-z. Non-ASCII bytes always belong to words.
LETTERS_DIGITS = np.zeros(256, bool)
LETTERS_DIGITS[ord("0") : ord("9") + 1] = LETTERS_DIGITS[ord("a") : ord("z") + 1] = True
LETTERS_DIGITS[128:] = True
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 9, 10, 11, 12, 13]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CHUNK_BYTES = 2 << 20  # text that is hashed together; bounds a task's memory
_BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))


_cache: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("up", ())) < n:
        size = max(n, _BLOCK + 1)
        _cache["up"], _cache["down"] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _cache["up"], _cache["down"]


@dataclass
class Words:
    """Words of several texts: byte ranges in `data`, the text of each, their 64-bit hashes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text, its first word; one more entry at the end

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def gram_hash(self, k: int) -> np.ndarray:
        """Hash of the k words from each position on; positions near a text's end are not valid."""
        n = max(0, len(self.hash) - k + 1)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total += self.hash[j : j + n] * np.uint64((_BASE * (2 * j + 3) | 1) & _MASK)
        return mix(total + np.uint64(k))

    def gram_valid(self, k: int) -> np.ndarray:
        n = max(0, len(self.doc) - k + 1)
        return self.doc[:n] == self.doc[k - 1 : k - 1 + n]

    def phrase(self, at: int, k: int) -> bytes:
        """The k words from `at` on, joined by one blank."""
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(at, at + k))


def split_words(texts: list[bytes], word_bytes: np.ndarray, borders=None) -> Words:
    """Lower-case A-Z and cut into runs of `word_bytes`; hash every run.

    `borders` maps the bytes to further places before which runs are cut.
    """
    data = LOWER[np.frombuffer(b" ".join(texts), np.uint8)] if texts else np.zeros(0, np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word_bytes[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    if borders is not None:
        cuts = np.flatnonzero(borders(data))
        start, end = np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    first = np.searchsorted(start, begins)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, start, end, doc, range_hashes(data, start, end), first)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each byte range, mixed; in blocks that begin and end with a word."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _BLOCK, "right")))
        low, high = int(start[i]), int(end[j - 1])
        up, down = _power_tables(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out)


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most `limit` bytes of text (or one row); null texts are empty."""
    for batch in batches:
        texts = _bytes_of(batch.column(column))
        sizes = np.asarray([len(t) for t in texts], np.int64)
        at = 0
        while at < len(texts):
            total = np.cumsum(sizes[at:])
            n = max(1, int(np.searchsorted(total, limit, "right")))
            yield batch.slice(at, n), texts[at : at + n]
            at += n


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Store a frame in the shared scratch folder and read it back: cuts lineage, runs once.

    Its shuffle files go as soon as it is stored, not when the driver next collects garbage.
    Texts reach Python by a few MB, not by ten thousand rows of whatever length.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, f"{purpose}-{uuid.uuid4().hex[:6]}")
    meanwhile = {CLEAN_UP: "true", BATCH_BYTES: str(2 * CHUNK_BYTES)}
    before = {name: spark.conf.get(name) for name in meanwhile}
    for name, value in meanwhile.items():
        spark.conf.set(name, value)
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
