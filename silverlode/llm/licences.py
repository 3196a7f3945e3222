"""License statements, notices and whole license texts: winnowed fingerprints, banded alignment.

Templates and documents are sequences of words without case and edge punctuation.

* **Fingerprints.** Each template is winnowed: of every few neighbouring words the rarest
  one is kept with its place. An alignment of ``COVERAGE`` misses ``m - need`` of a
  template's ``m`` words, the windows are narrow enough to leave more fingerprints than
  that, so every alignment keeps a known number of them. A fingerprint is one word,
  because words put in between may break every longer run of an alignment that counts.
* **Index.** An inverted index leads from a fingerprint to its templates. A document's
  distinct words are looked up once; templates with too few fingerprints are out, so the
  cost follows the entries met, not the number of templates.
* **Places.** Of what is left, a start in the document is a candidate where enough
  fingerprints stand within the band around its diagonal.
* **Alignment.** At a candidate the longest common subsequence within the band is counted,
  and where it covers enough, its span is taken. The band is ``BAND`` words, or a
  ``SHARE``-th of a longer template, whose starts are tried every eighth of the band.

Statements and notices are named only if their version and variant words align in order
and no other variant word stands between; whole texts (names in ``-full``), whose numbered
clauses are full of such words, go by the best alignment. Of finds that overlap the one
with more matched words stays.

NULL, empty and blank texts hold none. Texts of any length are scanned whole; memory grows
with the text, not with its finds. Equal finds: higher coverage, tighter span, first name,
first place. Repeated rows stay, an empty table gives an empty table, other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from importlib.resources import files

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from silverlode.llm.common import WordCache, picked, texts_of

#: Words an alignment may shift against the template; a longer template's own share of words.
BAND, SHARE = 4, 13
#: Share of a template's words that must align.
COVERAGE = 0.8
#: Ending of the names of whole license texts.
WHOLE = "-full"
#: Words that make another license of the same wording; words with digits do so too.
VARIANTS = {"affero", "alike", "commercial", "derivatives", "documentation", "lesser", "library", "nc", "nd", "noderivatives", "noncommercial", "sa", "sharealike"}
EDGES = "\"'`,;:!?#$%&*<>[](){}|."


def _gnu(license: str, version: str, program: str = "program", free: str = "free software:", tail: str = "or (at your option) any later version.") -> str:
    return f"This {program} is {free} you can redistribute it and/or modify it under the terms of the GNU {license} as published by the Free Software Foundation, either version {version} of the License, {tail}"


def _only(license: str, version: str) -> str:
    return f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {license} version {version} as published by the Free Software Foundation."


def _work(license: str, version: str) -> str:
    return f"This work is licensed under the GNU {license}, version {version}."


def _commons(variant: str) -> str:
    return f"This work is licensed under a Creative Commons Attribution{variant} 4.0 International License."


#: License statements and notices by name (fixed values: the usual public wordings).
STATEMENTS = {
    "AGPL-3.0": _work("Affero General Public License", "3"),
    "AGPL-3.0-notice": _gnu("Affero General Public License", "3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "CC-BY-4.0": _commons(""),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": _commons("-NonCommercial"),
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-ND-4.0-notice": _commons("-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-SA-4.0-notice": _commons("-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-ND-4.0-notice": _commons("-NoDerivatives"),
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-notice": _commons("-ShareAlike"),
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-1.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "GPL-2.0": _work("General Public License", "2"),
    "GPL-2.0-notice": _gnu("General Public License", "2", free="free software;"),
    "GPL-2.0-only-notice": _only("General Public License", "2"),
    "GPL-3.0": _work("General Public License", "3"),
    "GPL-3.0-notice": _gnu("General Public License", "3"),
    "GPL-3.0-only-notice": _only("General Public License", "3"),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "LGPL-2.0-notice": _gnu("Library General Public License", "2", "library", "free software;"),
    "LGPL-2.1": _work("Lesser General Public License", "2.1"),
    "LGPL-2.1-notice": _gnu("Lesser General Public License", "2.1", "library", "free software;"),
    "LGPL-3.0": _work("Lesser General Public License", "3"),
    "LGPL-3.0-notice": _gnu("Lesser General Public License", "3", "library"),
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-1.1-notice": 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Whole license texts, from the files of ``licence_texts``.
FULL = {f"{f.name.removesuffix('.txt')}{WHOLE}": f.read_text(encoding="utf-8") for f in files("silverlode.llm").joinpath("licence_texts").iterdir() if f.name.endswith(".txt")}
TEMPLATES = STATEMENTS | FULL


def plain(chunk: str) -> str:
    return chunk.strip(EDGES).lower()


def word_hash(chunk: str) -> int:
    w = plain(chunk)
    return xxhash.xxh3_64_intdigest(w) if w else 0


def aligned(template: list[int], words: list[int], band: int = BAND, at: int = 0) -> tuple[int, int, int]:
    """(words matched, first, last + 1) of the best alignment of a template in a window of words.

    Longest common subsequence within a band around the diagonal that starts at word
    ``at``, before the window where that is negative; of equal counts the tightest span
    wins, then the first.
    """
    m, n, width = len(template), len(words), 2 * band + 1
    seq = np.asarray(template, np.uint64)
    # a cell holds (matches, -first word) in one number, 0 without a match
    unit = n + 2
    places = np.arange(at - band, at + band + m)
    real = (places >= 0) & (places < n)
    padded = np.zeros(len(places), np.uint64)
    padded[real] = np.asarray(words, np.uint64)[places[real]]
    row, best = np.zeros(width + 1, np.int64), (0, 0, 0)
    for i in range(m):
        at_i = slice(i, i + width)
        here = (padded[at_i] == seq[i]) & real[at_i]
        more = np.where(here, np.where(row[:-1] > 0, row[:-1] + unit, unit + n - places[at_i]), 0)
        cells = np.maximum.accumulate(np.maximum(row[1:], more))
        ends = np.flatnonzero(here & (cells == more))
        if len(ends):
            matched, first = more[ends] // unit, n - more[ends] % unit
            span = places[at_i][ends] + 1 - first
            x = int(np.argmax(matched * unit - span))
            if (matched[x], -span[x]) > (best[0], best[1] - best[2]):
                best = (int(matched[x]), int(first[x]), int(first[x] + span[x]))
        row = np.append(cells, 0)
    return best


def common(masks: dict[int, int], m: int, words: list[int], band: int, at: int) -> int:
    """Words that ``aligned`` matches; the template is given by the places of each word as bits."""
    full, wide = (1 << m) - 1, (1 << (2 * band + 1)) - 1
    row = full  # zero bits count the matches (Hyyrö 2004)
    for j, w in enumerate(words):
        mask = masks.get(w)
        if mask:
            shift = j - at - band
            u = row & mask & (wide << shift if shift >= 0 else wide >> -shift)
            if u:
                row = ((row + u) | (row - u)) & full
    return m - row.bit_count()


def marked(word: str) -> bool:
    return any(c.isdigit() for c in word) or varied(word)


def varied(word: str) -> bool:
    return not VARIANTS.isdisjoint(word.split("-"))


class Template:
    """Words of a template and what finding it needs."""

    def __init__(self, text: str, whole: bool = False):
        words = [w for w in map(plain, text.split()) if w]
        self.seq = list(map(word_hash, words))
        self.m = len(words)
        # the float product that the coverage is compared by, so that equal shares pass
        self.need = next((n for n in range(self.m + 1) if self.m and n / self.m >= COVERAGE), self.m + 1)
        self.band = max(BAND, self.m // SHARE)
        self.step = max(1, self.band // 8)
        self.marks = [] if whole else [word_hash(w) for w in words if marked(w)]
        self.whole = whole
        self.masks: dict[int, int] = {}
        for i, h in enumerate(self.seq):
            self.masks[h] = self.masks.get(h, 0) | 1 << i
        self.words = np.unique(np.array(self.seq, np.uint64))

    def winnow(self, frequency: Counter[int]) -> None:
        """Keep the rarest word of every window; ``least`` of the kept places are in every alignment."""
        missed = self.m - self.need
        window = self.m // (missed + 1)
        order = [(frequency[h], h, -i) for i, h in enumerate(self.seq)]
        self.places = sorted({-min(order[i : i + window])[2] for i in range(self.m - window + 1)})
        self.least = len(self.places) - missed


class Scanner:
    """Templates and the inverted index of their fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.words = WordCache(word_hash)
        self.names = sorted(templates)
        self.templates = [Template(templates[x], x.endswith(WHOLE)) for x in self.names]
        frequency = Counter(h for t in self.templates for h in t.seq)
        postings: dict[int, list[int]] = {}
        for k, t in enumerate(self.templates):
            if t.m:
                t.winnow(frequency)
                for i in t.places:
                    postings.setdefault(t.seq[i], []).append(k)
        self.prints = np.array(sorted(postings), np.uint64)
        self.offsets = np.cumsum([0, *(len(postings[h]) for h in self.prints.tolist())])
        self.owners = np.array([k for h in self.prints.tolist() for k in postings[h]], np.int64)
        self.least = np.array([t.least if t.m else 1 for t in self.templates], np.int64)

    def candidates(self, ids: np.ndarray) -> list[int]:
        """Templates with enough fingerprints among the words."""
        if not len(self.prints):
            return []
        where = np.minimum(np.searchsorted(self.prints, ids), len(self.prints) - 1)
        present = np.unique(where[self.prints[where] == ids])
        if not len(present):
            return []
        met = np.concatenate([self.owners[self.offsets[x] : self.offsets[x + 1]] for x in present.tolist()])
        return np.flatnonzero(np.bincount(met, minlength=len(self.names)) >= self.least).tolist()

    def starts(self, t: Template, ids: np.ndarray) -> list[int]:
        """Places, before the text too, around whose diagonal enough fingerprints and words stand."""
        m, n, band = t.m, len(ids), t.band
        prints: dict[int, list[int]] = {}
        for i in t.places:
            prints.setdefault(t.seq[i], []).append(i)
        by_word = np.argsort(ids, kind="stable")
        ordered = ids[by_word]
        count = np.zeros(n + m, np.int32)
        for h, places in prints.items():
            word = np.uint64(h)
            lo, hi = np.searchsorted(ordered, word), np.searchsorted(ordered, word, "right")
            if lo == hi:
                continue
            at = by_word[lo:hi] + m
            edge = np.bincount(np.maximum(at - band, 0), minlength=n + 2 * m + 1)
            edge -= np.bincount(np.minimum(at + band + 1, n + 2 * m), minlength=n + 2 * m + 1)
            near = edge.cumsum() > 0
            for i in places:
                count += near[i : i + n + m]
        at = np.flatnonzero(count >= t.least) - m
        at = at[at % t.step == 0]
        first, last = np.clip(at - band, 0, n), np.clip(at + m + band, 0, n)
        for kind, least in ((t.words, t.need), *(([h], 1) for h in set(t.marks))):
            sums = np.concatenate([[0], np.isin(ids, np.array(kind, np.uint64)).cumsum()])
            keep = sums[last] - sums[first] >= least
            at, first, last = at[keep], first[keep], last[keep]
        return at.tolist()

    def finds(self, t: Template, ids: np.ndarray, varies: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(words matched, first, last + 1) of the alignments at candidate starts.

        The best come first; a start is passed over if all it can give overlaps a find
        that matched more words, or as many without a gap.
        """
        own, counted = set(t.seq), []
        for start in self.starts(t, ids):
            lo = max(0, start - t.band)
            k = common(t.masks, t.m, ids[lo : start + t.m + t.band].tolist(), t.band, start - lo)
            if k >= t.need:
                counted.append((-k, start, lo))
        seen: list[tuple[int, int, int]] = []
        for k, start, lo in sorted(counted):
            hi = min(start + t.m + t.band, len(ids))
            if any((n > -k or n == -k == b - a) and a - lo < -k and hi - b < -k and a >= lo and b <= hi for n, a, b in seen):
                continue
            k, a, b = aligned(t.seq, ids[lo:hi].tolist(), t.band, start - lo)
            span = ids[lo + a : lo + b].tolist()
            left = iter(span)
            # the marks stand there in their order, and no other variant's word
            if t.whole or all(h in left for h in t.marks) and not any(v and h not in own for v, h in zip(varies[lo + a : lo + b].tolist(), span, strict=True)):
                seen.append((k, lo + a, lo + b))
                yield k, lo + a, lo + b

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(name, coverage, start, end) in code points, each place once, by start.

        Overlapping finds keep the one with more matched words, then the higher coverage.
        """
        chunks = text.split()
        hashed = np.fromiter(map(self.words.__getitem__, chunks), np.uint64, len(chunks))
        real = np.flatnonzero(hashed)  # chunks of marks alone are no words
        ids = hashed[real]
        likely = self.candidates(ids)
        if not likely:
            return []
        varies = np.array([varied(plain(chunks[i])) for i in real.tolist()])
        found = set()
        for i in likely:
            t = self.templates[i]
            for n, a, b in self.finds(t, ids, varies):
                found.add((n, n / t.m, a - b, -i, -a, b))
        places = None
        taken: list[tuple[int, int]] = []
        out = []
        for _, cover, _, i, a, b in sorted(found, reverse=True):
            a = -a
            if all(b <= x or y <= a for x, y in taken):
                taken.append((a, b))
                if places is None:
                    places = [m.span() for m in re.finditer(r"\S+", text)]
                out.append((self.names[-i], cover, places[real[a]][0], places[real[b - 1]][1]))
        return sorted(out, key=lambda x: (x[2], x[3], x[0]))


def licences(df: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_found, names, spans (name:start:end:coverage).

    NULL and empty texts hold none; repeated rows stay; several finds come by place.
    """
    shared = df.sparkSession.sparkContext.broadcast(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for b in batches:
            found = [scanner.scan(t) for t in texts_of(b)]
            names = [",".join(sorted({x[0] for x in f})) for f in found]
            spans = [",".join(f"{x}:{a}:{z}:{c:.3f}" for x, c, a, z in f) for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(map(len, found)), pa.int64()), pa.array(names, pa.string()), pa.array(spans, pa.string())], ["doc_id", "n_found", "names", "spans"])

    return picked(df, doc_id=key, text=text).mapInArrow(run, "doc_id long, n_found long, names string, spans string")
