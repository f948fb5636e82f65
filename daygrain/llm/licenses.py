"""Licence notices by conditional compression: a block that a template explains well compresses well beside it.

Templates are one-sentence notices, file headers and licence bodies (``license_texts.txt``), and the tags
that name a licence. Blocks are windows over the words of a text, whatever its lines.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.session import ship

# The one-sentence notices looked for, licences that a tag may name beside those of the templates, and
# the words of which a text with a notice has one.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
TAGGED = "0BSD AFL-3.0 Artistic-2.0 CC-BY-3.0 EPL-2.0 EUPL-1.2 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later MIT-0 Python-2.0 WTFPL".split()
CANDIDATE = r"(?i)licen[sc]e|copyright|public domain|all rights reserved|creative commons|\bCC[ -]BY\b|\bCC0\b|permission is|provided\s+.?as.is"

WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
#: A window is compressed if it has so much of a template's number of words among the template's words, and looked at closely if that saves so much of its size.
COVERED, SAVED = 0.6, 0.15
#: What a word that differs counts against the bytes saved.
DIFFERENCE = 4
FOUND = "doc_id bigint, block int, license string, reduction double, n_missing int, n_added int, wording string, kind string, last_block int"


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


@dataclass(frozen=True)
class Template:
    license: str
    kind: str
    text: str


def standard_templates() -> list[Template]:
    """The notices, the headers and bodies of the text file, and a tag for each licence."""
    found = [Template(name, "notice", text) for name, text in TEMPLATES.items()]
    for part in pkgutil.get_data(__package__, "license_texts.txt").decode().split("## ")[1:]:
        first, text = part.split("\n", 1)
        found.append(Template(*first.split(), text))
    names = sorted({t.license for t in found} | set(TAGGED))
    return found + [Template(name, "tag", f"SPDX-License-Identifier: {name}") for name in names]


@dataclass
class Match:
    """The words from ``start`` to ``end`` are a template's, but for ``missing`` and ``added`` ones; ``saved`` bytes of ``alone``."""

    template: int
    start: int
    end: int
    missing: int
    added: int
    saved: int
    alone: int

    @property
    def rank(self) -> tuple:
        return (-(self.saved - DIFFERENCE * (self.missing + self.added)), self.missing + self.added, self.template, self.start)


class Scanner:
    """Ranks windows by how many bytes a template saves, used as raw dictionary, when they are compressed."""

    def __init__(self, templates: list[Template], level: int):
        import zstandard

        self.templates = sorted(templates, key=lambda t: (t.license, t.kind, t.text))
        self.words = [words_of(t.text) for t in self.templates]
        self.numbers = {w: k for k, w in enumerate(sorted({w for words in self.words for w in words}))}
        # The last column is for all words that no template has.
        self.has = np.zeros((len(self.templates), len(self.numbers) + 1), bool)
        for k, words in enumerate(self.words):
            self.has[k, [self.numbers[w] for w in words]] = True
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        # Raw content of under eight bytes is no dictionary: the text is repeated until it is.
        self.given = [
            zstandard.ZstdCompressor(
                level=level,
                write_content_size=False,
                dict_data=zstandard.ZstdCompressionDict((" ".join(words) + " ").encode() * 2, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for words in self.words
        ]

    def scan(self, words: list[str]) -> list[Match]:
        """The notices of a text in their order: each the best among all that overlap it."""
        ids = np.array([self.numbers.get(w, len(self.numbers)) for w in words], np.int64)
        found = {}
        for k, wording in enumerate(self.words):
            for start in self._windows(ids, k):
                if (match := self._match(words, k, start, start + len(wording))) is not None:
                    found[k, match.start, match.end] = match
        taken: list[Match] = []
        for match in sorted(found.values(), key=lambda m: m.rank):
            if all(match.end <= t.start or t.end <= match.start for t in taken):
                taken.append(match)
        return sorted(taken, key=lambda m: m.start)

    def _windows(self, ids: np.ndarray, k: int) -> list[int]:
        """Where windows of the template's length begin that hold most of its words: of those close together the fullest."""
        n = len(self.words[k])
        inside = np.concatenate(([0], np.cumsum(self.has[k, ids])))
        if inside[-1] < COVERED * n:
            return []
        covered = inside[np.minimum(np.arange(len(ids)) + n, len(ids))] - inside[:-1]
        places, found = np.flatnonzero(covered >= COVERED * n), []
        order = places[np.lexsort((places, -covered[places]))]
        free = np.ones(len(ids), bool)
        for at in order.tolist():
            if free[at]:
                found.append(at)
                free[max(0, at - n // 2) : at + n // 2 + 1] = False
        return found

    def _sizes(self, words: list[str], k: int) -> tuple[int, int]:
        block = " ".join(words).encode()
        alone = len(self.plain.compress(block))
        return alone - len(self.given[k].compress(block)), alone

    def _match(self, words: list[str], k: int, start: int, end: int) -> Match | None:
        saved, alone = self._sizes(words[start:end], k)
        if saved < SAVED * alone:
            return None
        wording = self.words[k]
        room = len(wording) // 3 + 2
        low = max(0, start - room)
        first, last, missing = _aligned(wording, words[low : end + room])
        if 5 * missing > len(wording):
            return None
        added = last - first - (len(wording) - missing)
        if 3 * added > len(wording):
            return None
        saved, alone = self._sizes(words[low + first : low + last], k)
        return Match(k, low + first, low + last, missing, added, saved, alone) if saved > 0 else None


def _aligned(template: list[str], words: list[str]) -> tuple[int, int, int]:
    """From where to where the template stands among the words, and how many of its words are missing, in order.

    A few words at either end that happen to be the template's, farther from the rest than they are many, are not counted.
    """
    blocks = [m for m in SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks() if m.size]
    while len(blocks) > 1 and blocks[1].b - blocks[0].b - blocks[0].size > blocks[0].size:
        blocks.pop(0)
    while len(blocks) > 1 and blocks[-1].b - blocks[-2].b - blocks[-2].size > blocks[-1].size:
        blocks.pop()
    if not blocks:
        return 0, 0, len(template)
    return blocks[0].b, blocks[-1].b + blocks[-1].size, len(template) - sum(m.size for m in blocks)


def _scanned(templates: list[Template], level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, level)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
                words = [text[a:b].lower() for a, b in spans]
                ends = np.array([m.start() for m in re.finditer("\n", text)], np.int64)
                for m in scanner.scan(words):
                    template = scanner.templates[m.template]
                    lines = np.searchsorted(ends, [spans[m.start][0], spans[m.end - 1][0]]).tolist()
                    rows.append((doc, lines[0], template.license, m.saved / m.alone, m.missing, m.added, " ".join(words[m.start : m.end]), template.kind, lines[1]))
            names = [n.split() for n in FOUND.split(", ")]
            types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, names)], [n for n, _ in names])

    return run


def licenses(docs: DataFrame, templates: list[Template] | None = None, level: int = 3) -> DataFrame:
    """One row for each licence notice in ``docs`` (doc_id, text; more columns are ignored).

    Columns: doc_id, block and last_block (the lines, from 0, in which the notice begins and ends), license,
    kind of the template (notice, header, body or tag), reduction (share of the compressed size that the
    template saves), n_missing (words of the template that are not there, at most a fifth), n_added
    (other words inside the notice, at most a third of the template's) and wording (the words found).
    Letter case, line ends and punctuation between words do not count. Where notices overlap, the one for which
    most bytes are saved counts, less some for each word that differs; ties go to the first name.
    Null and empty texts have no notice. Equal rows give equal results each; a null doc_id is kept as it is.
    """
    ship(docs.sparkSession)
    # Whole texts are searched, but only those with a candidate word leave the JVM.
    some = docs.where(F.col("text").rlike(CANDIDATE)).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return some.mapInArrow(_scanned(standard_templates() if templates is None else templates, level), FOUND)
