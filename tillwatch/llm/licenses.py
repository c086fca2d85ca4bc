"""License scans: winnowed template fingerprints find candidates, banded alignment reports spans.

An inverted index maps the fingerprints of all templates to their places. Equal
fingerprints of a text vote for a template and a diagonal; around each such place
the template is aligned with the text within a band, which allows for inserted,
missing and changed words, and says how much of the template is there and where.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.decontamination import winnow
from tillwatch.llm.text import LETTERS_DIGITS, split_words, text_chunks

# Public notices by which works name their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction"
    ),
}


@dataclass(frozen=True)
class LicenseParams:
    """Fingerprints are the smallest of `width` hashes of `gram` words: 5 equal words are always found."""

    gram: int = 3
    width: int = 3
    band: int = 8
    least_coverage: float = 0.8


@dataclass
class TemplateIndex:
    """Fingerprint -> (template, place); words of the templates as hashes."""

    names: list[str]
    words: list[np.ndarray]
    prints: np.ndarray
    places: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    @classmethod
    def of(cls, templates: Mapping[str, str], params: LicenseParams) -> TemplateIndex:
        names = list(templates)
        words = split_words([templates[n].encode() for n in names], LETTERS_DIGITS)
        if len(names) and words.count().min() < params.gram + params.width - 1:
            raise ValueError(f"templates need {params.gram + params.width - 1} words or more")
        hashes = words.gram_hash(params.gram)
        places: dict[int, list[tuple[int, int]]] = {}
        for at in winnow(hashes, words.gram_valid(params.gram), words.doc, params.width).tolist():
            template = int(words.doc[at])
            places.setdefault(int(hashes[at]), []).append((template, at - int(words.first[template])))
        prints = np.sort(np.fromiter(places, np.uint64, len(places)))
        return cls(names, np.split(words.hash, words.first[1:-1]), prints, places)


def align(text: np.ndarray, template: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """Most equal words in order with |text place - template place - shift| <= band.

    Returns their number and the first and last text place among them (-1 if none);
    of alignments with as many, the one with the shortest span.
    """
    none = (0, -1, -1)
    before = [none] * (2 * band + 1)
    for i in range(len(template)):
        row = []
        for d in range(2 * band + 1):
            j = i + shift + d - band  # place in the text
            best = before[d + 1] if d < 2 * band else none  # template word missing in the text
            if d and _better(row[d - 1], best):
                best = row[d - 1]  # extra word in the text
            if 0 <= j < len(text) and text[j] == template[i]:
                n, first, _ = before[d]
                step = (n + 1, first if n else j, j)
                if _better(step, best):
                    best = step
            row.append(best)
        before = row
    best = none
    for cell in before:
        if _better(cell, best):
            best = cell
    return best


def _better(a: tuple[int, int, int], b: tuple[int, int, int]) -> bool:
    return a[0] > b[0] or (a[0] == b[0] and a[0] > 0 and a[2] - a[1] < b[2] - b[1])


FOUND = "doc_id long, template string, start_word long, end_word long, matched_words long, coverage double"


def find_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, params: LicenseParams = LicenseParams()
) -> DataFrame:
    """One row per document and place where a template is covered well enough.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased;
    `[start_word, end_word)` spans the matched ones. Of overlapping places of one
    template the best stays. Null and empty texts have none; repeated rows report
    each; an empty table or no templates give no rows.
    """
    index = TemplateIndex.of(templates, params) if templates else None
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[doc], *found) for doc, found in _matches(texts, index, params)] if index else []
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, FOUND)


def _matches(texts: list[bytes], index: TemplateIndex, params: LicenseParams) -> Iterator[tuple[int, tuple]]:
    words = split_words(texts, LETTERS_DIGITS)
    hashes = words.gram_hash(params.gram)
    at = winnow(hashes, words.gram_valid(params.gram), words.doc, params.width)
    at = at[np.isin(hashes[at], index.prints)]
    votes: dict[tuple[int, int], set[int]] = {}
    for place in at.tolist():
        doc = int(words.doc[place])
        for template, offset in index.places[int(hashes[place])]:
            votes.setdefault((doc, template), set()).add(place - int(words.first[doc]) - offset)
    for (doc, template), shifts in sorted(votes.items()):
        own = words.hash[words.first[doc] : words.first[doc + 1]]
        target = index.words[template]
        found, last = [], None
        for shift in sorted(shifts):
            # Diagonals within half a band are seen from the first of them.
            if last is not None and shift - last <= params.band // 2:
                continue
            last = shift
            low = max(0, shift - params.band)
            part = own[low : shift + len(target) + params.band + 1]
            n, first, end = align(part, target, shift - low, params.band)
            if n >= params.least_coverage * len(target):
                found.append((n, first + low, end + low + 1))
        kept: list[tuple[int, int, int]] = []
        for n, first, end in sorted(found, key=lambda f: (-f[0], f[2] - f[1], f[1])):
            if all(end <= a or b <= first for _, a, b in kept):
                kept.append((n, first, end))
        for n, first, end in sorted(kept, key=lambda f: f[1]):
            yield doc, (index.names[template], first, end, n, n / len(target))
