"""Harmonic packing of tokenised documents into sequences of fixed capacity.

Class i holds pieces of `capacity // i` tokens, and a sequence of class i takes
exactly i of them. A document is cut into full sequences first, then greedily into
the largest class length that still fits; what is left below the smallest class
is strung together and cut where a sequence is full. Every task packs its own
rows, so there is no shuffle, and holds at most one open sequence per class. At a
task's end the open sequences are strung together too, and the last one is cut
into powers of two, so that padding is only `capacity % i` per sequence of class i.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.text import LETTERS_DIGITS, NOT_BLANK, Words, split_words, text_chunks

CAPACITY = 2048
CLASSES = 32
KNOWN_WORDS = 1_000_000
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
ID_BYTES = 4
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?")] = True
_ALNUM = LETTERS_DIGITS.copy()
_ALNUM[128:] = False


class WordTokenizer:
    """Token ids as little-endian 32-bit bytes, encoded word by word with a bounded memory.

    Right for tokenizers that lower-case, drop white space and part letters and
    digits from marks before they merge, so that no token crosses such a border.
    Words are remembered by their 64-bit hash.
    """

    def __init__(self, path: str, known_words: int = KNOWN_WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._limit = known_words
        self._forget()

    def _forget(self) -> None:
        self._slot: dict[int, int] = {}
        self._start, self._size = np.zeros(1, np.int64), np.zeros(1, np.int64)  # by slot
        self._pool = np.zeros(0, np.uint32)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. Texts that may hold special tokens, which respect case, go whole."""
        special = [i for i, t in enumerate(texts) if b"<|" in t]
        plain = [b"" if b"<|" in t else t for t in texts] if special else texts
        words = split_words(plain, NOT_BLANK, _border)
        hashes, first_of, back = np.unique(words.hash, return_index=True, return_inverse=True)
        slots = self._slots(words, hashes, first_of)
        start, size = self._start[slots][back], self._size[slots][back]
        ends = np.concatenate([[0], np.cumsum(size)])
        take = np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)
        ids, cuts = self._pool[take], ends[words.first]
        out = [ids[cuts[i] : cuts[i + 1]].astype("<u4").tobytes() for i in range(len(texts))]
        for i in special:
            code = self._tokenizer.encode(texts[i].decode("utf-8", "replace"), add_special_tokens=False)
            out[i] = np.asarray(code.ids, "<u4").tobytes()
        return out

    def _slots(self, words: Words, hashes: np.ndarray, first_of: np.ndarray) -> np.ndarray:
        get = self._slot.get
        slots = np.fromiter((get(h, -1) for h in hashes.tolist()), np.int64, len(hashes))
        new = np.flatnonzero(slots < 0)
        if len(new) and len(self._slot) + len(new) > self._limit and self._slot:
            self._forget()
            return self._slots(words, hashes, first_of)
        if len(new):
            at = first_of[new]
            data = words.data.tobytes()
            spans = zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)
            order, ids, sizes = self._encode([data[s:e].decode("utf-8", "replace") for s, e in spans])
            new = new[order]
            slots[new] = len(self._start) + np.arange(len(new))
            self._slot.update(zip(hashes[new].tolist(), slots[new].tolist(), strict=True))
            begins = len(self._pool) + np.concatenate([[0], np.cumsum(sizes)[:-1]])
            self._start, self._size = np.append(self._start, begins), np.append(self._size, sizes)
            self._pool = np.append(self._pool, ids)
        return slots

    def _encode(self, new: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Order in which the words were encoded, all their ids, and how many each has.

        Words of letters go together in one text, where each is one word for the
        tokenizer too; if normalising splits one of them they go one by one.
        """
        letters = [i for i, w in enumerate(new) if w.isalpha() and (w.isascii() or w.lower().isalpha())]
        ids, sizes = [], []
        if letters:
            joined = " ".join([new[i] for i in letters])
            code = self._tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0]
            number = np.asarray(code.word_ids)
            cuts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]]))
            if len(cuts) == len(letters) + 1:
                ids, sizes = [np.asarray(code.ids, np.uint32)], [np.diff(cuts)]
            else:
                letters = []
        done = set(letters)
        rest = [i for i in range(len(new)) if i not in done]
        codes = self._tokenizer.encode_batch_fast([new[i] for i in rest], add_special_tokens=False)
        flat = [i for code in codes for i in code.ids]
        ids.append(np.asarray(flat, np.uint32))
        sizes.append(np.asarray([len(code) for code in codes], np.int64))
        return letters + rest, np.concatenate(ids), np.concatenate(sizes)


def _border(data: np.ndarray) -> np.ndarray:
    """Places before which a word may be cut: between a letter or digit and a mark, in ASCII."""
    mark, alnum = _MARKS[data], _ALNUM[data]
    out = np.zeros(len(data), bool)
    out[1:] = (mark[1:] & alnum[:-1]) | (alnum[1:] & mark[:-1])
    return out


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer with the words it knows, kept between the tasks of a Python worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


class HarmonicPacker:
    """Packs pieces of documents; `rows` gathers the pieces of closed sequences."""

    def __init__(self, capacity: int, classes: int, first_id: int) -> None:
        if capacity < classes or classes < 2:
            raise ValueError("need 2 <= classes <= capacity")
        self.capacity, self.classes, self.next_id = capacity, classes, first_id
        self.open: dict[int, list[tuple]] = {}
        self.tail: list[tuple] = []
        self.tail_length = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, at = len(ids) // ID_BYTES, 0
        while at < total:
            rest = total - at
            if rest < self.capacity // self.classes:
                self._string((doc_id, at, rest, ids[at * ID_BYTES :], total))
                return
            i = max(1, self.capacity // rest)
            i += self.capacity // i > rest
            length = self.capacity // i
            piece = (doc_id, at, length, ids[at * ID_BYTES : (at + length) * ID_BYTES], total)
            held = self.open.setdefault(i, [])
            held.append(piece)
            if len(held) == i:
                self._close(held)
                self.open[i] = []
            at += length

    def _string(self, piece: tuple) -> None:
        """Append to the open tail sequence; cut the piece where it is full."""
        while piece:
            room = self.capacity - self.tail_length
            head, piece = _cut(piece, room)
            self.tail.append(head)
            self.tail_length += head[2]
            if self.tail_length == self.capacity:
                self._close(self.tail)
                self.tail, self.tail_length = [], 0

    def finish(self) -> None:
        for i in sorted(self.open):
            for piece in self.open[i]:
                self._string(piece)
        self.open = {}
        rest, pieces = self.tail_length, self.tail[::-1]
        while rest:
            room = size = 1 << (rest.bit_length() - 1)
            taken = []
            while room:
                head, left = _cut(pieces.pop(), room)
                taken.append(head)
                room -= head[2]
                if left:
                    pieces.append(left)
            self._close(taken)
            rest -= size
        self.tail, self.tail_length = [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, length, ids, total in pieces:
            self.rows.append((doc_id, start, length, ids, total, self.next_id, offset))
            offset += length
        self.next_id += 1


def _cut(piece: tuple, room: int) -> tuple[tuple, tuple | None]:
    doc_id, start, length, ids, total = piece
    if length <= room:
        return piece, None
    at = room * ID_BYTES
    return (doc_id, start, room, ids[:at], total), (doc_id, start + room, length - room, ids[at:], total)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    classes: int = CLASSES,
) -> DataFrame:
    """One row per piece: document, place in it, token ids (32-bit little-endian), sequence, offset.

    Needs columns `doc_id` and `text`; others are ignored. A null or empty text is
    just `end_id`. Repeated rows and repeated or null ids are packed like any others;
    an empty table gives no rows. Sequence ids are unique (task number, then count).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        packer = HarmonicPacker(capacity, classes, TaskContext.get().partitionId() << 33)
        end = end_id.to_bytes(ID_BYTES, "little")
        for batch, texts in text_chunks(batches):
            ids = tokenizer.ids(texts)
            for doc_id, code in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                packer.add(doc_id, code + end)
            yield _rows(packer)
        packer.finish()
        yield _rows(packer)

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, SCHEMA)


def _rows(packer: HarmonicPacker) -> pa.RecordBatch:
    columns = list(zip(*packer.rows, strict=True)) or [()] * 7
    packer.rows = []
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
