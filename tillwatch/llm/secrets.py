"""Secret scans: fixed patterns, and a battery of randomness tests for encoded keys.

Runs of characters that could be an encoded key are put to three tests of the
alphabet inferred for them: chi-squared uniformity, the number of runs above and
below the alphabet's middle, and serial correlation. A run fails as soon as one of
them is significant. Not failing says little about short runs, so each run also
gets the probability that text of its length would look as even as it does (a
non-central chi-squared one); these are held to a false-discovery rate within each
class of lengths, over all documents. Only a histogram of them is gathered.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.text import text_chunks, written

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX_LEAST = 24
KINDS = ("assign", "access", "hex")

def _table(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX = _table(_DIGITS + "abcdef")
_KEY = _table(_DIGITS + _LOW + _UP + "+/_-")
#: Alphabets in the order in which they are tried; the first that has all characters is inferred.
ENCODINGS = {
    "rand_hex": _DIGITS + "abcdef",
    "rand_hexup": _DIGITS + "ABCDEF",
    "rand_base32": _UP + "234567",
    "rand_base36": _DIGITS + _LOW,
    "rand_base62": _UP + _LOW + _DIGITS,
    "rand_base64": _UP + _LOW + _DIGITS + "+/",
    "rand_base64url": _UP + _LOW + _DIGITS + "-_",
}
_PLACE = {name: {c: i for i, c in enumerate(chars)} for name, chars in ENCODINGS.items()}


@dataclass(frozen=True)
class BatteryParams:
    """`alpha`: level of each test; `rate`: false discoveries; `distance`: how uneven text is, per character."""

    least_length: int = 20
    alpha: float = 0.001
    rate: float = 0.01
    distance: float = 1.0
    strata: tuple[int, ...] = (32, 64, 128)  # upper ends of the classes of lengths


def _normal_tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def chi_squared_tail(x: float, free: int) -> float:
    """P(chi-squared with `free` degrees of freedom > x), by the cube-root transformation."""
    v = 2 / (9 * free)
    return _normal_tail(((x / free) ** (1 / 3) - (1 - v)) / math.sqrt(v))


def noncentral_chi_squared(x: float, free: int, shift: float) -> float:
    """P(non-central chi-squared <= x), by a power transformation to the normal."""
    k, s = free, shift
    h = 1 - 2 * (k + s) * (k + 3 * s) / (3 * (k + 2 * s) ** 2)
    p = (k + 2 * s) / (k + s) ** 2
    m = (h - 1) * (1 - 3 * h)
    mean = 1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p)
    return _normal_tail((mean - (x / (k + s)) ** h) / (h * math.sqrt(2 * p) * (1 + 0.5 * m * p)))


def battery(run: str, params: BatteryParams) -> tuple[str, float] | None:
    """Inferred encoding and the text probability; None if the run is no candidate or fails a test.

    Candidates mix letters and digits: other runs are words.
    """
    if not any(c in _DIGITS for c in run) or not any(c not in "0123456789+/_-" for c in run):
        return None
    name = next((n for n, place in _PLACE.items() if all(c in place for c in run)), None)
    if name is None:
        return None
    size, n = len(ENCODINGS[name]), len(run)
    values = np.asarray([_PLACE[name][c] for c in run])
    cells = min(size, 16)
    seen = np.bincount(values * cells // size, minlength=cells)
    share = np.bincount(np.arange(size) * cells // size, minlength=cells) / size
    x = float(((seen - n * share) ** 2 / (n * share)).sum())
    if chi_squared_tail(x, cells - 1) < params.alpha:
        return None
    high = values >= size / 2
    a = int(high.sum())
    b = n - a
    if not a or not b:
        return None
    mean = 1 + 2 * a * b / n
    spread = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if 2 * _normal_tail(abs(runs - mean) / spread) < params.alpha:
        return None
    centred = values - values.mean()
    serial = float((centred[1:] * centred[:-1]).sum() / max(1e-9, (centred**2).sum()))
    if 2 * _normal_tail(abs(serial + 1 / n) * math.sqrt(n)) < params.alpha:
        return None
    return name, noncentral_chi_squared(x, cells - 1, n * params.distance)


def _long_runs(data: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = member[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def base_spans(text: bytes, hex_runs: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns in code points, by start and then kind."""
    found = [("hex", s, e) for s, e in hex_runs]
    lower = text.lower()
    if any(k in lower for k in KEYWORDS) or b"AKIA" in text:
        whole = text.decode("utf-8", "replace")
        for m in ASSIGN.finditer(whole):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append(("assign", m.start(), m.end()))
        for m in ACCESS.finditer(whole):
            if m.end() - m.start() >= ACCESS_LEAST:
                found.append(("access", m.start(), m.end()))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


SPAN = "struct<kind: string, start: long, end: long>"
SCAN = f"doc_id long, base array<{SPAN}>, runs array<struct<kind: string, start: long, end: long, p: double>>"


def scan_secrets(docs: DataFrame, params: BatteryParams = BatteryParams()) -> DataFrame:
    """Per row of `docs`: doc_id, `base` and `found` spans (kind, start, end; code points, end exclusive).

    `found` are runs that pass the battery and the false-discovery rate and lie in
    no base span. A null or empty text has no spans; rows stay apart even if ids
    repeat; an empty table gives no rows.
    """
    bounds = params.strata

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            data = np.frombuffer(b"\n".join(texts), np.uint8) if texts else np.zeros(0, np.uint8)
            begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
            hexes = _by_text(texts, begins, *_long_runs(data, _HEX, HEX_LEAST))
            keys = _by_text(texts, begins, *_long_runs(data, _KEY, params.least_length))
            base, runs = [], []
            for i, text in enumerate(texts):
                spans = base_spans(text, [(s, e) for s, e, _ in hexes.get(i, ())])
                own = []
                for s, e, value in keys.get(i, ()):
                    if any(s < y and x < e for _, x, y in spans):
                        continue
                    if result := battery(value, params):
                        own.append({"kind": result[0], "start": s, "end": e, "p": result[1]})
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                runs.append(own)
            span = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
            columns = [
                batch.column("doc_id"),
                pa.array(base, pa.list_(pa.struct(span))),
                pa.array(runs, pa.list_(pa.struct([*span, ("p", pa.float64())]))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "runs"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = written(chosen.mapInArrow(run, SCAN), "secrets")
    limits = _limits(scanned, params)
    found = F.filter("runs", lambda r: r.p <= _limit_for(r, bounds, limits))
    slim = F.transform(found, lambda r: F.struct(r.kind.alias("kind"), r.start.alias("start"), r.end.alias("end")))
    return scanned.select("doc_id", "base", slim.alias("found"))


def _limit_for(run, bounds: tuple[int, ...], limits: list[float]):
    size = run.end - run.start
    out = F.lit(limits[-1])
    for bound, limit in zip(reversed(bounds), reversed(limits[:-1]), strict=True):
        out = F.when(size < bound, F.lit(limit)).otherwise(out)
    return out


def _limits(scanned: DataFrame, params: BatteryParams) -> list[float]:
    """Largest probability that counts as a discovery, per class of lengths (step-up rule on cells)."""
    size = F.col("r.end") - F.col("r.start")
    stratum = F.lit(0)
    for bound in params.strata:
        stratum = stratum + (size >= bound).cast("int")
    cell = F.least(F.lit(160), F.floor(-4 * F.log10(F.greatest(F.col("r.p"), F.lit(1e-40)))))
    cells = scanned.select(F.explode("runs").alias("r")).groupBy(stratum.alias("stratum"), cell.alias("cell")).count()
    counts = np.zeros((len(params.strata) + 1, 161))
    for row in cells.collect():  # at most 161 cells for each class
        counts[int(row["stratum"]), int(row["cell"])] = row["count"]
    limits = []
    for of_class in counts:
        total, below, limit = of_class.sum(), 0.0, -1.0
        for cell in range(160, -1, -1):
            below += of_class[cell]
            upper = 10 ** (-cell / 4)  # no value of the cell is larger
            if below and upper <= params.rate * below / total:
                limit = upper
        limits.append(limit)
    return limits


def _by_text(texts: list[bytes], begins: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict:
    """Runs by text, in code points, with their characters."""
    out: dict[int, list[tuple[int, int, str]]] = {}
    for s, e in zip(start.tolist(), end.tolist(), strict=True):
        i = int(np.searchsorted(begins, s, "right")) - 1
        at = s - int(begins[i])
        before = len(texts[i][:at].decode("utf-8", "replace"))
        value = texts[i][at : at + e - s].decode("ascii")
        out.setdefault(i, []).append((before, before + e - s, value))
    return out
