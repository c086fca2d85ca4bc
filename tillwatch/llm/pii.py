"""Personal data by a semi-Markov conditional random field, beside fixed patterns.

Text around digits and `@` is cut into atoms. A segment of atoms is scored as a
whole (how many digits in which groups, separators, checksums, what stands before
and after it), and dynamic programming over segments of bounded length chooses
boundaries and types together. The weights maximise the likelihood of what the
fixed patterns find in a bounded sample of documents; the features do not contain
the patterns, so the model also finds what narrowly misses them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.text import text_chunks

# The patterns of the base kinds, with conditions in `base_spans`.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")

ANCHOR = re.compile(r"[0-9@]")
ATOM = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")
REACH = 64  # characters to either side of an anchor that may belong to an entity
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns in code points, by start and then kind."""
    found: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            done = domain.end()
            found.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(_at_most_255(part) for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def _at_most_255(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and int(digits) <= 255)


@dataclass(frozen=True)
class FieldParams:
    """`sample`: documents with digits or `@` whose regions are fitted on, `parts` of them at most.

    `atoms` and `digits` bound an entity.
    """

    sample: int = 1_500
    parts: int = 400
    atoms: int = 24
    digits: int = 24
    steps: int = 40
    penalty: float = 0.05
    least_margin: float = 4.0  # log odds of an entity over plain text


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Parts of a text that can hold entities: what lies within reach of an anchor on its line."""
    low = high = -1
    for m in ANCHOR.finditer(text):
        at = m.start()
        if at < high:
            continue
        start, end = at, at + 1
        floor = max(0, at - REACH, high)
        while start > floor and not text[start - 1].isspace():
            start -= 1
        stop = min(len(text), at + REACH)
        while end < stop and not text[end].isspace():
            end += 1
        if low >= 0 and start - high <= 2 and text[high:start].strip(" ") == "":
            high = end
        else:
            if low >= 0:
                yield low, high
            low, high = start, end
    if low >= 0:
        yield low, high


FEATURES = 40


def segment_features(text: str, start: int, end: int, atoms: list[str]) -> list[int]:
    """Numbers of the features of a whole segment; at most one of each group."""
    digit_runs = [a for a in atoms if a[0] in "0123456789"]
    letters = sum(a[0].isalpha() for a in atoms)
    digits = sum(map(len, digit_runs))
    marks = [a for a in atoms if not a[0].isalnum()]
    kinds = set(marks)
    before = text[start - 1] if start else " "
    after = text[end] if end < len(text) else " "
    out = [0, 1 + min(8, digits // 2), 10 + min(5, len(digit_runs)), 16 + min(3, letters)]
    if "@" in kinds:
        out.append(20 if marks.count("@") == 1 else 21)
    dots = marks.count(".")
    out.append(22 + min(3, dots))
    if atoms[0] == "+":
        out.append(26)
    if "(" in kinds or ")" in kinds:
        out.append(27 if marks.count("(") == marks.count(")") else 28)
    if " " in kinds:
        out.append(29)
    if "-" in kinds:
        out.append(30)
    if kinds - set("@.+()- _%"):
        out.append(31)
    if letters == 0 and digits >= 12:
        out.append(32 if luhn("".join(digit_runs)) else 33)
    if letters == 0 and digit_runs and max(map(len, digit_runs)) <= 3 and len(digit_runs) == 4:
        out.append(34 if all(int(a) <= 255 for a in digit_runs) else 35)
    if before.isalnum() or before in "+@":
        out.append(36)
    if after.isalnum() or after == "@":
        out.append(37)
    if not atoms[-1][0].isalnum() or not (atoms[0][0].isalnum() or atoms[0] in "+("):
        out.append(38)
    if "@" in kinds and atoms[-1][0].isalpha() and len(atoms) > 2 and atoms[-2] == ".":
        out.append(39)
    return out


@dataclass
class Lattice:
    """All segments of a region that hold an anchor: first and last atom, and features of each."""

    atoms: list[tuple[int, int]]
    first: np.ndarray
    last: np.ndarray
    features: list[list[int]]

    @classmethod
    def of(cls, text: str, start: int, end: int, params: FieldParams) -> Lattice:
        atoms = [(m.start(), m.end()) for m in ATOM.finditer(text, start, end)]
        words = [text[s:e] for s, e in atoms]
        digits = [len(w) if w[0] in "0123456789" else 0 for w in words]
        first, last, features = [], [], []
        for i in range(len(atoms)):
            anchored, held = False, 0
            for j in range(i, min(len(atoms), i + params.atoms)):
                held += digits[j]
                if held > params.digits:
                    break
                anchored = anchored or digits[j] > 0 or words[j] == "@"
                if anchored:
                    first.append(i)
                    last.append(j)
                    features.append(segment_features(text, atoms[i][0], atoms[j][1], words[i : j + 1]))
        return cls(atoms, np.asarray(first, int), np.asarray(last, int), features)

    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.features), FEATURES), np.float32)
        for row, numbers in zip(out, self.features, strict=True):
            row[numbers] = 1
        return out

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """(segments, kinds); sums of the weights of each segment's features."""
        if not self.features:
            return np.zeros((0, len(KINDS)))
        numbers = np.fromiter((f for row in self.features for f in row), int)
        begins = np.cumsum([0, *map(len, self.features[:-1])])
        return np.add.reduceat(weights.T[numbers], begins, axis=0)


def best_segments(lattice: Lattice, weights: np.ndarray, margin: float) -> list[tuple[int, int, int]]:
    """(first atom, last atom, type) of the best cut; atoms outside score nothing."""
    n = len(lattice.atoms)
    scores = lattice.scores(weights) - margin
    kind = scores.argmax(1) if len(scores) else np.zeros(0, int)
    ending: list[list[int]] = [[] for _ in range(n)]
    for s in np.flatnonzero(scores.max(1) > 0) if len(scores) else ():
        ending[lattice.last[s]].append(s)
    best, back = [0.0] * (n + 1), [-1] * (n + 1)
    for j in range(n):
        best[j + 1] = best[j]
        for s in ending[j]:
            value = best[lattice.first[s]] + scores[s, kind[s]]
            if value > best[j + 1]:
                best[j + 1], back[j + 1] = value, s
    out, j = [], n
    while j > 0:
        s = back[j]
        if s < 0:
            j -= 1
        else:
            out.append((int(lattice.first[s]), int(lattice.last[s]), int(kind[s])))
            j = int(lattice.first[s])
    return out[::-1]


def _log_add(a: float, b: float) -> float:
    high = max(a, b)
    return high if high == -math.inf else high + math.log(math.exp(a - high) + math.exp(b - high))


def _gradient(
    lattice: Lattice, matrix: np.ndarray, gold: list[tuple[int, int, int]], weights: np.ndarray
) -> np.ndarray:
    """Gradient of a cut's log likelihood, by forward and backward sums over segments."""
    n, scores = len(lattice.atoms), matrix @ weights.T
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    total = np.logaddexp.reduce(scores, axis=1)
    by_end: list[list[int]] = [[] for _ in range(n)]
    by_start: list[list[int]] = [[] for _ in range(n)]
    for s, (i, j) in enumerate(zip(lattice.first, lattice.last, strict=True)):
        by_end[j].append(s)
        by_start[i].append(s)
    for j in range(n):
        value = forward[j]
        for s in by_end[j]:
            value = _log_add(value, forward[lattice.first[s]] + total[s])
        forward[j + 1] = value
    for i in range(n - 1, -1, -1):
        value = backward[i + 1]
        for s in by_start[i]:
            value = _log_add(value, backward[lattice.last[s] + 1] + total[s])
        backward[i] = value
    at = np.asarray(forward)[lattice.first] + np.asarray(backward)[lattice.last + 1] - forward[n]
    expected = np.exp(np.minimum(0, at[:, None] + scores))
    index = {(i, j): s for s, (i, j) in enumerate(zip(lattice.first.tolist(), lattice.last.tolist(), strict=True))}
    gain = -expected
    for i, j, k in gold:
        gain[index[(i, j)], k] += 1
    return gain.T @ matrix


def fit_field(docs: DataFrame, params: FieldParams = FieldParams()) -> np.ndarray:
    """Weights (kinds, features) from at most `sample` documents with anchors, chosen by a hash of id and text.

    Only their regions come to the driver. With none, no segment is likelier than text.
    """
    text = F.col("text").cast("string")
    chosen = docs.select(text.alias("text")).filter(text.rlike("[0-9@]")).withColumn("h", F.xxhash64("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            hashes, parts = [], []
            for h, raw in zip(batch.column("h").to_pylist(), texts, strict=True):
                body = raw.decode("utf-8", "replace")
                found = list(regions(body))
                # A region with one character to either side, which its features look at.
                parts.append([body[max(0, s - 1) : e + 1] for s, e in found if e - s <= 4 * REACH])
                hashes.append(h)
            arrays = [pa.array(hashes, pa.int64()), pa.array(parts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, ["h", "parts"])

    # Each task passes on its first `sample` rows of that order, so one task sees few.
    rows = chosen.mapInArrow(cut, "h long, parts array<string>").orderBy("h", "parts").limit(params.sample).collect()
    parts = sorted({p for row in rows for p in row.parts}, key=lambda p: (zlib.crc32(p.encode()), p))
    lattices = []
    for part in parts[: params.parts]:
        lattice = Lattice.of(part, 0, len(part), params)
        if lattice.features:
            lattices.append((lattice, lattice.matrix(), _gold(part, lattice)))
    weights = np.zeros((len(KINDS), FEATURES))
    weights[:, 0] = -params.least_margin
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, params.steps + 1 if lattices else 1):
        gradient = -params.penalty * weights
        for lattice, matrix, gold in lattices:
            gradient += _gradient(lattice, matrix, gold, weights)
        gradient /= len(lattices)
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        weights += 0.3 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return weights


def _gold(text: str, lattice: Lattice) -> list[tuple[int, int, int]]:
    """Base spans as segments; of spans that overlap the longest stays."""
    starts = {s: i for i, (s, _) in enumerate(lattice.atoms)}
    ends = {e: i for i, (_, e) in enumerate(lattice.atoms)}
    known = set(zip(lattice.first.tolist(), lattice.last.tolist(), strict=True))
    taken: list[tuple[int, int, int]] = []
    for kind, s, e in sorted(base_spans(text), key=lambda f: (f[1] - f[2], f[1])):
        segment = (starts.get(s), ends.get(e))
        if segment in known and all(segment[1] < i or j < segment[0] for i, j, _ in taken):
            taken.append((*segment, KINDS.index(kind)))
    return sorted(taken)


FOUND = "doc_id long, base array<struct<kind: string, start: long, end: long>>, found array<struct<kind: string, start: long, end: long>>"


def find_pii(docs: DataFrame, weights: np.ndarray, params: FieldParams = FieldParams()) -> DataFrame:
    """Per row of `docs`: doc_id, `base` and `found` spans (kind, start, end; code points, end exclusive).

    `found` are the model's segments that overlap no base span. A null or empty text
    has no spans; rows stay apart even if ids repeat; an empty table gives no rows.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            base, more = [], []
            for raw in texts:
                text = raw.decode("utf-8", "replace")
                own = base_spans(text) if ANCHOR.search(text) else []
                base.append(_records(own))
                more.append(_records(_modelled(text, own, weights, params)))
            columns = [batch.column("doc_id"), pa.array(base, span), pa.array(more, span)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "found"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, FOUND)


def _records(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def _modelled(text: str, own: list[Span], weights: np.ndarray, params: FieldParams) -> list[Span]:
    out: list[Span] = []
    for start, end in regions(text):
        lattice = Lattice.of(text, start, end, params)
        for i, j, kind in best_segments(lattice, weights, params.least_margin):
            s, e = lattice.atoms[i][0], lattice.atoms[j][1]
            if not any(s < y and x < e for _, x, y in own):
                out.append((KINDS[kind], s, e))
    return out
