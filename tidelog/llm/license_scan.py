"""License notices in documents.

Templates are short notices, standard file headers and whole license texts. They are cut
into word k-grams. Of each window of k-grams the one with the smallest hash is kept
(winnowing), and an inverted index says in which template and where it stands. A document
looks up all its k-grams; hits of one template on nearby diagonals are a candidate. The
candidate stretch of the document and the template are aligned word by word within a band
around these diagonals, and the matched words give the coverage and the spans. The band
of a long template follows its hits, so that words put in or left out do not end it.
SPDX lines are read as they stand, with whatever identifiers they have.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from importlib.resources import files

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import read_table

GRAM = 3
WINDOW = 2
BAND = 6
MIN_COVERAGE = 0.6
#: Templates of so many words have longer k-grams and wider windows.
LONG = 30
LONG_GRAM = 5
LONG_WINDOW = 8
#: Share of the kept k-grams of a long template that a candidate must hit.
LONG_HITS = 0.05
WORD = re.compile(r"[^\W_]+")

#: Short public notices by which texts name their license. Headers and whole
#: texts are files of the package ``licenses``.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
}

TERMS_END = "END OF TERMS AND CONDITIONS"
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]*)", re.IGNORECASE)
SPDX_WORD = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+:-]*")


def all_templates() -> dict[str, list[str]]:
    """Notices, file headers and whole texts by license; what follows the terms of a text,
    how to apply them, is left out."""
    found = {name: [text] for name, text in TEMPLATES.items()}
    for file in sorted(files("tidelog.llm.licenses").iterdir(), key=lambda one: one.name):
        if file.name.endswith(".txt"):
            name = file.name.removesuffix(".txt").removesuffix(".header")
            found.setdefault(name, []).append(file.read_text("utf-8").split(TERMS_END)[0])
    return found


def gram_hash(words: list[str]) -> int:
    return zlib.crc32(" ".join(words).encode("utf-8", "replace"))


def winnowed(words: list[str], gram: int = GRAM, window: int = WINDOW) -> list[tuple[int, int]]:
    """(hash, place) of the smallest hash of each window, the last one of equals. A text
    shorter than a k-gram has one, all its words."""
    size = min(gram, len(words))
    hashes = [gram_hash(words[at : at + size]) for at in range(len(words) - size + 1)] if words else []
    kept = set()
    for at in range(max(1, len(hashes) - window + 1) if hashes else 0):
        kept.add(min(range(at, min(at + window, len(hashes))), key=lambda place: (hashes[place], -place)))
    return [(hashes[place], place) for place in sorted(kept)]


@dataclass
class Index:
    names: list[str]
    words: list[list[str]]
    places: dict[int, dict[int, list[tuple[int, int]]]]  # by size of the k-gram, by hash
    vocabulary: dict[int, set[str]]  # by size of the k-gram
    hits: list[int]  # different places that a candidate must hit

    @classmethod
    def of(cls, templates: Mapping[str, str | Sequence[str]], gram: int = GRAM) -> Index:
        pairs = [(name, text) for name, own in templates.items() for text in ([own] if isinstance(own, str) else own)]
        names, words = [name for name, _ in pairs], [WORD.findall(text.lower()) for _, text in pairs]
        places, vocabulary, hits = defaultdict(lambda: defaultdict(list)), defaultdict(set), []
        for number, own in enumerate(words):
            size, kept = min(gram, len(own)), winnowed(own, gram)
            if len(own) >= LONG:
                size, kept = LONG_GRAM, winnowed(own, LONG_GRAM, LONG_WINDOW)
                # A k-gram that a template repeats would hit diagonals far from the copy.
                often = Counter(gram_hash(own[at : at + size]) for at in range(len(own) - size + 1))
                kept = [(value, place) for value, place in kept if often[value] == 1]
            hits.append(max(2, int(len(kept) * LONG_HITS)) if len(own) >= LONG else 1)
            vocabulary[size].update(own)
            for value, place in kept:
                places[size][value].append((number, place))
        return cls(names, words, {size: dict(own) for size, own in places.items()}, dict(vocabulary), hits)


def aligned(
    template: list[str], words: list[str], shift: int | list[tuple[int, int]], band: int
) -> list[tuple[int, int]]:
    """Matched (template place, word place) of a longest common sequence.

    Only cells whose word place is within ``band`` of template place + shift are filled,
    so the work is the length of the template times the width of the band. A list has the
    smallest and the largest shift of each template place.
    """
    best: list[dict[int, tuple[int, int]]] = [{}]
    for row, own in enumerate(template):
        above, line = best[-1], {}
        least, most = (shift, shift) if isinstance(shift, int) else shift[row]
        low, high = max(0, row + least - band), min(len(words) - 1, row + most + band)
        for column in range(low, high + 1):
            up, left = above.get(column, (0, 0))[0], line.get(column - 1, (0, 0))[0]
            if own == words[column]:
                corner = above.get(column - 1, (0, 0))[0] + 1
                line[column] = (corner, 2) if corner >= max(up, left) else ((up, 1) if up >= left else (left, 0))
            else:
                line[column] = (up, 1) if up >= left else (left, 0)
        best.append(line)
    row = len(template)
    column = max(best[row], key=lambda at: (best[row][at][0], -at), default=-1)
    matched = []
    while row > 0 and column >= 0 and column in best[row]:
        _, step = best[row][column]
        if step == 2:
            matched.append((row - 1, column))
            row, column = row - 1, column - 1
        elif step == 1:
            row -= 1
        else:
            column -= 1
    return matched[::-1]


def rising(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest chain of (template place, shift) in which both the template place and the
    place in the document rise."""
    ordered = sorted(set(hits), key=lambda hit: (hit[0], -hit[1]))
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for number, (own, shift) in enumerate(ordered):
        at = bisect_left(ends, own + shift)
        before.append(last[at - 1] if at else -1)
        if at == len(ends):
            ends.append(own + shift)
            last.append(number)
        else:
            ends[at], last[at] = own + shift, number
    chain, number = [], last[-1]
    while number >= 0:
        chain.append(ordered[number])
        number = before[number]
    return chain[::-1]


def along(chain: list[tuple[int, int]], length: int, start: int) -> list[tuple[int, int]]:
    """Smallest and largest shift of each template place, less ``start``: that of the hits
    on both sides of it."""
    shifts, at = [], 0
    for row in range(length):
        while at < len(chain) and chain[at][0] < row:
            at += 1
        sides = [chain[max(0, at - 1)][1] - start, chain[min(at, len(chain) - 1)][1] - start]
        shifts.append((min(sides), max(sides)))
    return shifts


def gram_hits(words: list[str], index: Index) -> dict[int, list[tuple[int, int]]]:
    """(template place, shift) of the k-grams of a text that the index has, by template."""
    hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for size, places in index.places.items():
        vocabulary, run = index.vocabulary[size], 0
        for end, word in enumerate(words, 1):
            run = run + 1 if word in vocabulary else 0
            if run >= size:
                for number, own in places.get(gram_hash(words[end - size : end]), ()):
                    hits[number].append((own, end - size - own))
    return hits


def spdx_notices(text: str) -> Iterator[tuple[str, float, int, int, int]]:
    """(license, coverage, words, start, end) of each identifier of the SPDX lines, the
    first from the start of the line on. An exception after WITH is no license."""
    for line in SPDX.finditer(text):
        start, joint = line.start(), "OR"
        for one in SPDX_WORD.finditer(text, line.start(1), line.end(1)):
            if one[0].upper() in ("AND", "OR", "WITH"):
                joint = one[0].upper()
            elif not joint:
                break  # behind the expression
            else:
                if joint != "WITH":
                    first = one.start() if start is None else start
                    yield one[0], 1.0, len(WORD.findall(text[first : one.end()])), first, one.end()
                start, joint = None, ""


def without_overlaps(matches: list[tuple]) -> list[tuple]:
    """Of matches (.., .., .., start, end, ..) that overlap the first, in order of places.

    What is kept does not overlap, so a match can only touch the two next to its place.
    """
    kept: list[tuple] = []
    starts: list[int] = []
    for one in matches:
        at = bisect_right(starts, one[3])
        free_before = at == 0 or kept[at - 1][4] <= one[3]
        free_behind = at == len(kept) or one[4] <= kept[at][3]
        if free_before and free_behind:
            kept.insert(at, one)
            starts.insert(at, one[3])
    return kept


def scan(text: str, index: Index, band: int = BAND) -> list[tuple[str, float, int, int, int, str]]:
    """(license, coverage, matched words, start, end, matched text) of each notice.

    start and end are places of characters. Of matches that overlap, the one with the
    most matched words is reported, then the largest coverage, then the first template.
    """
    found = [match for match in WORD.finditer(text.lower())] if index.places else []
    if len(text.lower()) != len(text):  # a few letters become longer; places must fit
        found = list(WORD.finditer(text))
    words = [match[0].lower() for match in found]
    matches = [(count, coverage, -1, start, end, name) for name, coverage, count, start, end in spdx_notices(text)]
    for number, hits in gram_hits(words, index).items():
        template = index.words[number]
        long = len(template) >= LONG
        reach = max(band, len(template) // 8) if long else band
        ordered = sorted(set(hits), key=lambda hit: hit[1])
        group: list[tuple[int, int]] = []
        for hit in [*ordered, None]:
            if group and (hit is None or hit[1] - group[-1 if long else 0][1] > reach):
                if len({own for own, _ in group}) >= index.hits[number]:
                    chain = rising(group) if long else group
                    shifts = [shift for _, shift in chain]
                    low = max(0, min(shifts) - band)
                    stretch = words[low : max(shifts) + len(template) + band]
                    lanes = along(chain, len(template), low) if long else shifts[0] - low
                    pairs = aligned(template, stretch, lanes, band)
                    coverage = len(pairs) / len(template)
                    if coverage >= MIN_COVERAGE:
                        first, last = found[low + pairs[0][1]], found[low + pairs[-1][1]]
                        matches.append((len(pairs), coverage, number, first.start(), last.end(), index.names[number]))
                group = []
            if hit is not None:
                group.append(hit)
    matches.sort(key=lambda one: (-one[0], -one[1], one[2], one[3]))
    kept = without_overlaps(matches)
    return [(name, coverage, count, start, end, text[start:end]) for count, coverage, _, start, end, name in kept]


NOTICES = "ARRAY<STRUCT<license STRING, coverage DOUBLE, matched_words INT, start INT, end INT, matched STRING>>"


def scan_documents(docs: DataFrame, templates: Mapping[str, str | Sequence[str]] | None = None) -> DataFrame:
    """(doc_id, notices) for every row of ``docs``, in the order of their places.

    Null, empty and other texts without a notice have an empty list. Repeated rows give
    repeated results. templates: name and text, or texts; they are sent to every task.
    """
    index = docs.sparkSession.sparkContext.broadcast(Index.of(templates or all_templates()))

    @F.pandas_udf(NOTICES)
    def notices(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ["license", "coverage", "matched_words", "start", "end", "matched"]
        for texts in batches:
            yield pd.Series(
                [[dict(zip(names, one, strict=True)) for one in scan(text or "", index.value)] for text in texts],
                dtype=object,
            )

    return docs.select("doc_id", notices(F.col("text")).alias("notices"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document with its notices; n_notices is 0 without any."""
    found = scan_documents(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("notices").alias("n_notices"), "notices")
