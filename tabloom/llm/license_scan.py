"""License scan: winnowed fingerprints, an inverted index of the templates,
and banded sequence alignment.

Words are lower-cased and stripped of outer punctuation.  Hashes of GRAM
words are winnowed (the least of each WINDOW of neighbours), in templates
and texts alike, so every run of GRAM + WINDOW - 1 words they share shares a
fingerprint.  The inverted index gives (template, position) per fingerprint;
hits on like diagonals are one candidate; a global alignment of the template
inside a band around them counts matched words, and is repeated on the rest
of the candidate.  A match whose coverage of the template reaches ``least``,
and whose version numbers and license names are exactly the template's, is
reported with its character span.  Templates are notices and every paragraph
of whole license texts, so parts of a text are found too; a paragraph that
licenses share is reported for each.  The templates are a short parameter and travel with the job; texts
are scanned whole where they lie, without a shuffle.

Defined cases: null and empty texts match nothing; null ids stay; repeated
rows report each; a template shorter than the fingerprint run is refused; an
empty table gives an empty result; of candidates of one template that
overlap, the one of higher coverage (then the first) stays; one mostly
covered by a fuller match of its license, or a closer one of another, is
dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import spread
from tabloom.llm.license_texts import TEXTS

GRAM, WINDOW = 3, 2
LEAST_WORDS = 12        # of a paragraph; a shorter one joins the next
BAND = 8
LEAST = 0.75
PUNCT = ".,;:!?()[]{}<>\"'`*#%&$|/\\-_"
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint64)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

_NUMBER = re.compile(r"v?([0-9]+(?:\.[0-9]+)*)")
_NAMES = frozenset(("affero apache bsd cc cc0 gnu gpl isc lesser lgpl agpl mit mozilla mpl unlicense"
                    " mit-style bsd-style attribution noncommercial sharealike noderivatives"
                    " attribution-noncommercial attribution-sharealike").split())
_BEFORE_VERSION = frozenset("version v gpl lgpl agpl mpl apache".split())

# Notices by license, and their wordings.
_SAY = ("Released under the {}.", "Licensed under the {}.", "This work is licensed under the {}.")
_GNU = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the"
        " GNU {} as published by the Free Software Foundation{} either version {} of the License")
TEMPLATES = {
    "Apache-2.0": [
        *(x.format("Apache License, Version 2.0") for x in _SAY),
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at"],
    "MPL-2.0": [
        *(x.format("Mozilla Public License, version 2.0") for x in _SAY),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC0-1.0": [
        "Released under CC0 1.0 Universal.", "Licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or"
        " neighboring rights to this work under CC0 1.0"],
    "Unlicense": [
        *(x.format("Unlicense") for x in _SAY),
        "This is free and unencumbered software released into the public domain."],
}
for _id, _name in (("MIT", "MIT License"), ("ISC", "ISC License"),
                   ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License")):
    TEMPLATES[_id] = [x.format(_name) for x in _SAY]
TEMPLATES["MIT"].append("Permission is hereby granted, free of charge, to any person obtaining a copy"
                        " of this software and associated documentation files")
for _id, _name, _versions in (
        ("GPL", "General Public License", ("2", "3")),
        ("LGPL", "Lesser General Public License", ("2.1", "3")),
        ("AGPL", "Affero General Public License", ("3",))):
    for _v in _versions:
        TEMPLATES[f"{_id}-{_v if '.' in _v else _v + '.0'}"] = [
            *(x.format(f"GNU {_name}, version {_v}") for x in _SAY),
            _GNU.format("program", ":", _name, ",", _v), _GNU.format("library", ";", _name, ";", _v)]
for _kind, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
                      ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                      ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v in ("2.0", "3.0", "4.0"):
        TEMPLATES[f"CC-{_kind}-{_v}"] = [
            f"Licensed under CC {_kind} {_v}.", f"Licensed under a Creative Commons {_words} {_v}"
            f" {'International' if _v == '4.0' else 'Unported'} License."]


def paragraphs(text: str) -> list[str]:
    out, held = [], ""
    for part in re.split(r"\n\s*\n", text.strip()):
        held = f"{held}\n{part}" if held else part
        if len(tokens(held)) >= LEAST_WORDS:
            out.append(held)
            held = ""
    if held and out:
        out[-1] += "\n" + held
    return out or [held]


def all_templates() -> dict[str, list[str]]:
    """Notices, then the paragraphs of the whole texts, by license."""
    return {name: TEMPLATES.get(name, []) + (paragraphs(TEXTS[name]) if name in TEXTS else [])
            for name in [*TEMPLATES, *(n for n in TEXTS if n not in TEMPLATES)]}


def marks(ws: list[str]) -> list[str]:
    """The words that must agree exactly: versions, and names of licenses."""
    out = []
    for i, w in enumerate(ws):
        number = _NUMBER.fullmatch(w)
        before = ws[i - 1] if i else ""
        if number and ("." in number[1] or w[0] == "v" or before in _BEFORE_VERSION):
            out.append(number[1].removesuffix(".0"))
        elif w in _NAMES or w.startswith(("by-", "attribution-")) or w.endswith("-clause") or (
                w == "by" and before == "cc") or (
                w == "library" and ws[i + 1:i + 3] == ["general", "public"]):
            out.append(w)
    return out


def tokens(text: str) -> list[str]:
    return [w.strip(PUNCT) for w in _WORD.findall(text.lower())]


def fingerprints(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the winnowed grams of known words (id > 0)."""
    n = len(ids) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    x = ids.astype(np.uint64)
    h = sum((x[i:i + n] + np.uint64(i)) * _MIX[i] for i in range(GRAM))
    h = (h ^ (h >> np.uint64(15))) * np.uint64(0x2C1B3C6D)
    known = np.ones(n, dtype=bool)
    for i in range(GRAM):
        known &= ids[i:i + n] > 0
    h = np.where(known, h, np.uint64(0xFFFFFFFFFFFFFFFF))
    pick = np.zeros(n, dtype=bool)
    if n < WINDOW:
        pick[:] = True
    else:
        windows = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
        pick[np.arange(len(windows)) + windows.argmin(axis=1)] = True
    at = np.flatnonzero(pick & known)
    return at, h[at]


class Index:
    """Word ids, template id sequences and the fingerprint postings."""

    def __init__(self, templates: dict[str, list[str]]):
        self.names, self.seqs, self.marks, self.words = [], [], [], {}
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for name, texts in templates.items():
            for text in texts:
                ws = tokens(text)
                if len(ws) < GRAM + WINDOW - 1:
                    raise ValueError(f"template of {name} is too short: {text}")
                ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in ws])
                at, hashes = fingerprints(ids)
                for p, h in zip(at.tolist(), hashes.tolist()):
                    self.postings.setdefault(h, []).append((len(self.seqs), p))
                self.names.append(name)
                self.seqs.append(ids)
                self.marks.append(marks(ws))
        self.hashes = np.array(sorted(self.postings), dtype=np.uint64)


def align(seq: np.ndarray, text: np.ndarray, lo: int, hi: int) -> tuple[int, int, int]:
    """(matched words, first, last position + 1 in text) of the best alignment
    of the template with text along diagonals lo..hi (text - template)."""
    width = hi - lo + 1
    best = [(0, -1, -1)] * (width + 1)      # row before, by diagonal; last: outside
    for i, want in enumerate(seq.tolist()):
        row: list[tuple[int, int, int]] = []
        for d in range(width):
            p = i + lo + d
            up = best[d + 1] if d + 1 < width else (0, -1, -1)   # template word left out
            left = row[d - 1] if d else (0, -1, -1)              # text word left out
            top = max(up, left, key=lambda c: c[0])
            if 0 <= p < len(text) and text[p] == want:
                n, first, _ = best[d]
                hit = (n + 1, p if first < 0 else first, p + 1)
                if hit[0] >= top[0]:
                    top = hit
            elif best[d][0] > top[0]:
                top = best[d]
            row.append(top)
        best = [*row, (0, -1, -1)]
    return max(best, key=lambda c: c[0])


def gain(x: tuple) -> float:
    """Matched words less the template's words that are missing."""
    return x[3] * (2 - 1 / x[2])


def hides(y: tuple, x: tuple) -> bool:
    """Whether match y leaves nothing to say about match x."""
    if 2 * (min(x[5], y[5]) - max(x[4], y[4])) <= x[5] - x[4]:
        return False
    if y[0] == x[0]:
        return gain(y) > gain(x)
    return y[2] > x[2] and y[3] >= x[3]


def scan(text: str | None, index: Index, least: float = LEAST) -> list[tuple]:
    """(license, template, coverage, matched, start, end) of one text."""
    if not text:
        return []
    get = index.words.get
    said = tokens(text)
    ids = np.array([get(w, 0) for w in said], dtype=np.int64)
    at, hashes = fingerprints(ids)
    near = np.minimum(np.searchsorted(index.hashes, hashes), len(index.hashes) - 1)
    hit = index.hashes[near] == hashes
    spots: dict[int, list[tuple[int, int]]] = {}
    for p, h in zip(at[hit].tolist(), hashes[hit].tolist()):
        for template, q in index.postings[h]:
            spots.setdefault(template, []).append((p - q, p))
    found = []
    for template, hits in spots.items():
        seq = index.seqs[template]
        diagonals = sorted({d for d, _ in hits})
        groups = [[diagonals[0], diagonals[0]]]
        for d in diagonals[1:]:
            if d - groups[-1][1] <= BAND and d - groups[-1][0] <= 2 * BAND:
                groups[-1][1] = d
            else:
                groups.append([d, d])
        rows = []
        for lo, hi in groups:
            start = max(lo - BAND, 0)
            rest = ids[start:hi + BAND + len(seq)].copy()
            # no alignment matches more words than the region has of the template
            while np.isin(seq, rest).sum() >= least * len(seq):
                n, first, last = align(seq, rest, lo - BAND - start, hi + BAND - start)
                if n < least * len(seq):
                    break
                rest[first:last] = 0        # the rest may hold another occurrence
                first, last = first + start, last + start
                if marks(said[first:last]) == index.marks[template]:
                    rows.append((n / len(seq), -first, n, last))
        taken: list[tuple[int, int]] = []
        for coverage, first, n, last in sorted(rows, reverse=True):
            if all(last <= a or -first >= b for a, b in taken):
                taken.append((-first, last))
                found.append((index.names[template], template, coverage, n, -first, last))
    kept: list[tuple] = []
    for x in sorted(found, key=lambda x: (-gain(x), x)):
        if not any(hides(y, x) for y in kept):
            kept.append(x)
    found = kept
    if not found:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    return sorted((name, t, c, n, spans[a][0], spans[b - 1][1]) for name, t, c, n, a, b in found)


def scan_documents(docs: DataFrame, templates: dict[str, list[str]] | None = None,
                   id_col: str = "doc_id", text_col: str = "text",
                   least: float = LEAST) -> DataFrame:
    """One row per document: doc_id, n_matches, and matches (license,
    template, coverage, matched, start, end)."""
    index = docs.sparkSession.sparkContext.broadcast(Index(templates or all_templates()))
    match = pa.struct([("license", pa.string()), ("template", pa.int32()),
                       ("coverage", pa.float64()), ("matched", pa.int32()),
                       ("start", pa.int64()), ("end", pa.int64())])
    keys = [f.name for f in match]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[dict(zip(keys, r)) for r in scan(t, index.value, least)]
                    for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(r) for r in rows], pa.int32()),
                 pa.array(rows, pa.list_(match))], names=["doc_id", "n_matches", "matches"])

    rows = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              F.col(text_col).alias("text")))
    return rows.mapInArrow(run, (
        "doc_id long, n_matches int, matches array<struct<license: string, template: int, "
        "coverage: double, matched: int, start: bigint, end: bigint>>"))
