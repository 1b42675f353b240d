"""License scans by conditional compression.

Every confirmed wording is sought in the words of the whole text, so neither line breaks nor the
length of a line decide: words of text and template are aligned, and a span is confirmed if at most
MAX_CHANGED of the template's words differ. A template with k differences at most, cut into k + 1
pieces, has one piece unchanged in the text; spans are aligned around each such place. Of spans that
overlap the one with most words in common is taken, and what is left of the text is searched on.

Runs of lines that mention licensing and what confirmed spans leave of them are candidate blocks too.
Windows around their mentions, as long as the longest template, are compressed alone and with each
template as zstandard raw dictionary; the template that shrinks one most (as a share of its size
alone) is the likely wording. The winners, best first, are aligned as well.

Defined cases. A null or empty text has no block, nor has one that mentions nothing. A null doc_id is
carried through. Blocks are whole, however long. Each
confirmed wording is a row of its own. line is where the first mention run that a row touches begins. Ties in size go to the earlier template. Repeated
rows give repeated blocks; an empty table gives none. Other columns of docs are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmith.llm import _shared as S

MENTION = r"(?i)licen[sc]|copyright|\bpermission is hereby\b|redistribut|warrant|spdx|\bgpl\b|creative commons|\bcc.by\b|\bcc0\b|public domain"
TRIED, TIE = 3, 0.02
LEAST_GAIN = 0.2
MAX_CHANGED = 0.15
LEVEL = 3

#: Wordings of license notices (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, '
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-3-Clause-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Released under the CC0 1.0 public domain dedication.",
}
_WORDS = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


class Scanner:
    """Templates as compression dictionaries."""

    def __init__(self, templates: dict[str, str]):
        self.names, self.texts = list(templates), list(templates.values())
        self.words = [words_of(x) for x in self.texts]
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.primed = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(x.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for x in self.texts]

    def scan(self, block: str) -> dict:
        """The best confirmed template, else the most likely one, with the wording's differences."""
        data = block.lower().encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(data))
        sizes = [len(c.compress(data)) for c in self.primed]
        ranked = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        gains = [(alone - sizes[i]) / alone for i in ranked]
        likely = [i for k, (i, g) in enumerate(zip(ranked, gains, strict=True)) if g >= LEAST_GAIN and (k < TRIED or g >= gains[0] - TIE)]
        words, best = words_of(block), None
        for i in likely:
            added, missing = differences(words, self.words[i])
            row = {"license": self.names[i], "confirmed": added + missing <= MAX_CHANGED * len(self.words[i]), "n_added": added, "n_missing": missing}
            row |= {"gain": round((alone - sizes[i]) / alone, 4), "bytes_alone": alone, "bytes_given": sizes[i]}
            if best is None or (not row["confirmed"], added + missing) < (not best["confirmed"], best["n_added"] + best["n_missing"]):
                best = row
        empty = {"license": None, "confirmed": False, "n_added": None, "n_missing": None, "gain": round(gains[0], 4), "bytes_alone": alone, "bytes_given": sizes[ranked[0]]}
        return best or empty


def differences(words: list[str], template: list[str]) -> tuple[int, int]:
    """Words of the block inside its aligned part that the template lacks, and the reverse."""
    aligned = [m for m in SequenceMatcher(None, words, template, autojunk=False).get_matching_blocks() if m.size]
    if not aligned:
        return len(words), len(template)
    same = sum(m.size for m in aligned)
    return aligned[-1].a + aligned[-1].size - aligned[0].a - same, len(template) - same


BLOCK = "doc_id long, line long, text string"
FOUND = "license string, confirmed boolean, n_added int, n_missing int, gain double, bytes_alone int, bytes_given int"


class Finder:
    """All confirmed wordings of a text, and the likely ones of what else mentions licensing."""

    def __init__(self, templates: dict[str, str]):
        self.scanner, self.mention, self.known = Scanner(templates), re.compile(MENTION), {}
        self.reach = max(map(len, self.scanner.words), default=0)
        #: First word of a piece: (rest of the piece, template, the piece's place in it, differences allowed).
        self.pieces: dict[str, list[tuple[list[str], int, int, int]]] = {}
        for i, words in enumerate(self.scanner.words):
            most = int(MAX_CHANGED * len(words))
            cuts = [len(words) * k // (most + 1) for k in range(most + 2)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e > s:
                    self.pieces.setdefault(words[s], []).append((words[s:e], i, s, most))

    def confirmed(self, words: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(start, stop, template, added, missing) of disjoint spans of words, in order."""
        places: dict[tuple[int, int], int] = {}
        for at, word in enumerate(words):
            for piece, i, offset, most in self.pieces.get(word, ()):
                if words[at : at + len(piece)] == piece:
                    places[i, at - offset] = most
        found = []
        for (i, start), most in places.items():
            template = self.scanner.words[i]
            # The narrowest window first: words around a wording must not be aligned with it.
            for slack in range(most + 1):
                low = max(0, start - slack)
                part = words[low : max(0, start + len(template) + slack)]
                same = [m for m in SequenceMatcher(None, part, template, autojunk=False).get_matching_blocks() if m.size]
                added, missing = differences(part, template)
                if same and added + missing <= MAX_CHANGED * len(template):
                    found.append((len(template) - added - 2 * missing, low + same[0].a, low + same[-1].a + same[-1].size, i, added, missing))
        taken: list[tuple[int, int, int, int, int]] = []
        for _, s, e, i, added, missing in sorted(found, key=lambda x: (-x[0], x[3], x[1])):
            if all(e <= x[0] or s >= x[1] for x in taken):
                taken.append((s, e, i, added, missing))
        return sorted(taken)

    def likely(self, block: str) -> dict:
        """The best row of the windows around a block's mentions."""
        words = [m.span() for m in _WORDS.finditer(_lower(block))]
        if len(words) <= 2 * self.reach:
            return self.scanned(block)
        starts, rows, after = [s for s, _ in words], [], -1
        for m in self.mention.finditer(block):
            if m.start() < after:
                continue
            at = max(0, bisect_right(starts, m.start()) - 1)
            low, high = max(0, at - self.reach // 2), min(len(words), at + self.reach)
            after = words[min(high, at + self.reach // 2 + 1) - 1][1]
            rows += [self.scanned(block[words[low][0] : words[high - 1][1]]), self.scanned(block[words[at][0] : words[min(len(words), at + 12) - 1][1]])]
        return min(rows, key=lambda r: (not r["confirmed"], r["license"] is None, -r["gain"])) if rows else self.scanned(block)

    def scanned(self, block: str) -> dict:
        if block not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            self.known[block] = self.scanner.scan(block)
        return self.known[block]

    def rows(self, text: str) -> Iterator[tuple[int, str, dict]]:
        """(line, text, FOUND) of each candidate block that no wording covers, then of each confirmed wording."""
        runs, lines, at = [], [], 0
        for i, line in enumerate(text.split("\n")):
            lines.append(at)
            if self.mention.search(line):
                if runs and runs[-1][1] == i - 1:
                    runs[-1][1:] = i, at + len(line)
                else:
                    runs.append([i, i, at + len(line)])
            at += len(line) + 1
        low = _lower(text)
        spans = [m.span() for m in _WORDS.finditer(low)]
        wordings = [(spans[s][0], spans[e - 1][1], *rest) for s, e, *rest in self.confirmed([low[a:b] for a, b in spans])]
        for first, _, stop in runs:
            at, left = lines[first], []
            for s, e, *_ in wordings:
                if s < stop and e > at:
                    left.append((at, s))
                    at = max(at, e)
            whole = not left
            for s, e in [*left, (at, stop)]:
                if whole or (s < e and self.mention.search(text, s, e)):
                    row = self.likely(text[s:e])
                    if whole or row["license"]:
                        yield first, text[s:e], row
        for s, e, i, added, missing in wordings:
            line = next((first for first, _, stop in runs if lines[first] < e and stop > s), bisect_right(lines, s) - 1)
            data = text[s:e].lower().encode("utf-8", "surrogatepass")
            alone, given = len(self.scanner.plain.compress(data)), len(self.scanner.primed[i].compress(data))
            yield line, text[s:e], {"license": self.scanner.names[i], "confirmed": True, "n_added": added, "n_missing": missing, "gain": round((alone - given) / alone, 4), "bytes_alone": alone, "bytes_given": given}


def _lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row per confirmed wording and per other candidate block: BLOCK and FOUND. license is null where no template shrinks the block."""
    wordings = dict(templates or TEMPLATES)
    mentioned = docs.where(F.col("text").rlike(MENTION)).select(F.col("doc_id").cast("long"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(wordings)
        kinds = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
        fields = [x.split() for x in f"{BLOCK}, {FOUND}".split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows += [{"doc_id": doc_id, "line": line, "text": part} | row for line, part, row in finder.rows(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[t]) for n, t in fields], [n for n, _ in fields])

    return mentioned.mapInArrow(run, f"{BLOCK}, {FOUND}")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(S.table(spark, sf_dir, "documents"))


S.by_value(__name__)
