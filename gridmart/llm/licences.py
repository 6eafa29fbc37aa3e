"""Licence scans with a generalised suffix automaton of licence words.

All templates and phrases are put into one suffix automaton. A file's words stream through it and
give matching statistics: at each word, the longest run ending there that stands in some template.
Runs that cannot be prolonged and have at least ``min_match`` words are anchors; the anchors of a
template that follow one another in file and template alike are chained, and a chain that covers
``min_cover`` of its template is a span with the template's label. Copies of a template are spans of
their own, however close they stand: after the best chain, the words before and after it are searched
again, and a chain over words that hold two spans is split. Phrases are counted wherever all their
words stand consecutively.

Words are runs of digits, ASCII letters (lower case) and anything beyond ASCII. The automaton's
size depends on the templates only; a file is streamed whole, whatever its length.

Defined results: null text = empty; a text without words has no label and score 0; repeated rows
are scanned each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts

# Passages by which licences are named or granted.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
    ),
    "apache-2": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the "
        "license at http www apache org licenses license 2 0",
    ),
    "gpl-3": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation",
    ),
    "cc-by-nc": (
        "licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ),
    "cc-by": (
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    "mpl-2": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
}
PHRASES = {
    "mit": ("under the mit license",),
    "apache-2": ("apache license version 2",),
    "cc-by-nc": ("cc by nc",),
}
BLANKS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32
    for b in range(256)
)
SPAN = "struct<label:string,first_word:bigint,last_word:bigint,coverage:double>"
FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    f"base_labels array<string>, spans array<{SPAN}>, score double"
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(BLANKS).split()


class Automaton:
    """Suffix automaton of several sequences; a state is a number."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.size, self.link = [0], [-1]
        ends: list[set[tuple[int, int]]] = [set()]
        for s, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word, ends)
                ends[last].add((s, i))
        for state in sorted(range(1, len(self.size)), key=lambda v: -self.size[v]):
            ends[self.link[state]] |= ends[state]
        #: where the runs of a state end: (sequence, position)
        self.ends = [sorted(e) for e in ends]
        #: whole sequences that are suffixes of a state's longest run
        self.whole: list[list[int]] = [[] for _ in self.size]
        for s, sequence in enumerate(sequences):
            state = 0
            for word in sequence:
                state = self.next[state][word]
            self.whole[state].append(s)
        for state in sorted(range(1, len(self.size)), key=lambda v: self.size[v]):
            self.whole[state] = self.whole[self.link[state]] + self.whole[state]

    def _state(self, size: int, ends: list, like: int | None = None) -> int:
        self.next.append({} if like is None else dict(self.next[like]))
        self.size.append(size)
        self.link.append(0 if like is None else self.link[like])
        ends.append(set())
        return len(self.size) - 1

    def _extend(self, last: int, word: int, ends: list) -> int:
        have = self.next[last].get(word)
        if have is not None:
            return have if self.size[have] == self.size[last] + 1 else self._split(last, word, ends)
        state, at = self._state(self.size[last] + 1, ends), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            exact = self.size[to] == self.size[at] + 1
            self.link[state] = to if exact else self._split(at, word, ends)
        return state

    def _split(self, at: int, word: int, ends: list) -> int:
        """A state of its own for the shorter runs of ``at``'s successor."""
        to = self.next[at][word]
        twin = self._state(self.size[at] + 1, ends, like=to)
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = twin
            at = self.link[at]
        self.link[to] = twin
        return twin

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest run that ends with ``word``."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.size[state]
        to = self.next[state].get(word)
        return (0, 0) if to is None else (to, length + 1)


Match = tuple[int, int, int]  # file start, template start, length
Chain = tuple[int, int, int]  # template words covered, first and last word in the file


def _ends(size: int, matches: list[Match], tight: bool = False) -> Iterator[Chain]:
    """The best chain that ends with each of the sorted matches; ``tight``: of equals the shortest."""
    # tops[p]: the best chain that ends before template position p
    tops: list[Chain] = [(0, -1, -1)] * (size + 1)
    for start, at, length in matches:
        for cut in range(length - 1):  # what the chain before covers already is cut off
            covered, first, last = tops[at + cut]
            if last < start + cut:
                break
        else:
            continue
        end = start + length - 1
        new = (covered + length - cut, first if first >= 0 else start + cut, end)
        for p in range(at + length, size + 1):
            if tops[p][0] > new[0] or tops[p][0] == new[0] and (not tight or tops[p][1] >= new[1]):
                break
            tops[p] = new
        yield new


def _best(size: int, matches: list[Match]) -> Chain:
    """The chain that covers most; of equals a tight one in the middle, so that halves remain."""
    if not matches:
        return 0, -1, -1
    middle = matches[0][0] + matches[-1][0] + matches[-1][2]
    best = max(
        _ends(size, matches, tight=True), key=lambda c: (c[0], -abs(c[1] + c[2] - middle)), default=(0, -1, -1)
    )
    return max(best, *_ends(size, matches), key=lambda c: c[0])


def _between(matches: list[Match], begin: int, end: int | None = None) -> list[Match]:
    """What lies from word ``begin`` to ``end`` of the matches, two words at least."""
    found = []
    for start, at, length in matches:
        cut = max(begin - start, 0)
        rest = length - cut if end is None else min(length, end - start) - cut
        if rest > 1:
            found.append((start + cut, at + cut, rest))
    return sorted(found)


class Scanner:
    def __init__(self, templates: dict, phrases: dict, min_match: int, min_cover: float):
        named = [(label, text, False) for label, texts in templates.items() for text in texts]
        named += [(label, text, True) for label, texts in phrases.items() for text in texts]
        split = [words_of(text.encode()) for _, text, _ in named]
        if any(len(s) < 2 for s in split) or min_match < 2:
            raise ValueError("templates, phrases and matches need two words at least")
        self.labels, self.is_phrase = [n[0] for n in named], [n[2] for n in named]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for s in split for w in s}))}
        self.sequences = [[self.vocabulary[w] for w in s] for s in split]
        self.automaton = Automaton(self.sequences)
        self.pairs = np.zeros((len(self.vocabulary) + 1,) * 2, bool)
        for s in self.sequences:
            self.pairs[s[:-1], s[1:]] = True
        self.min_match, self.min_cover = min_match, min_cover

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches (begin, end) whose neighbouring words all stand side by side in a template.
        Elsewhere the matching statistic is at most one word."""
        good = np.zeros(len(ids) + 1, np.int8)
        good[1:-1] = self.pairs[ids[:-1], ids[1:]]
        edges = np.flatnonzero(np.diff(good))
        return [(int(a), int(b) + 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]

    def anchors(self, ids: np.ndarray) -> tuple[dict[int, list[tuple[int, int, int]]], list]:
        """Unprolongable matches (file start, template start, length) by template, and the places
        (start, phrase) of whole phrases."""
        matches: dict[int, list[tuple[int, int, int]]] = {}
        places: list[tuple[int, int]] = []
        step, ends = self.automaton.step, self.automaton.ends
        for begin, end in self.runs(ids) if len(ids) > 1 else ():
            state = length = 0
            for i in range(begin, end + 1):
                before, held = state, length
                state, length = step(state, length, int(ids[i])) if i < end else (0, 0)
                if held >= self.min_match and length <= held:
                    for s, at in ends[before]:
                        if not self.is_phrase[s]:
                            matches.setdefault(s, []).append((i - held, at - held + 1, held))
                for s in self.automaton.whole[state] if length else ():
                    if self.is_phrase[s] and length >= (size := len(self.sequences[s])):
                        places.append((i - size + 1, s))
        return matches, places

    def chains(self, s: int, matches: list[Match]) -> tuple[list[tuple[int, int, float]], float]:
        """(first word, last word, coverage) of the chains that are spans, and the best coverage."""
        size = len(self.sequences[s])
        clusters: list[list[Match]] = []
        for match in sorted(matches):
            if clusters and match[0] - clusters[-1][-1][0] <= size:
                clusters[-1].append(match)
            else:
                clusters.append([match])
        spans, top = [], 0
        for cluster in clusters:
            top = max(top, max(c[0] for c in _ends(size, cluster)))
            left = [cluster]
            while left:
                some = left.pop()
                best = _best(size, some)
                if best[0] / size < self.min_cover:
                    continue
                if at := self._second(size, _between(some, best[1], best[2] + 1)):
                    left += [_between(some, 0, at), _between(some, at)]
                else:
                    spans.append((best[1], best[2], best[0] / size))
                    left += [_between(some, 0, best[1]), _between(some, best[2] + 1)]
        return spans, top / size

    def _second(self, size: int, matches: list[Match]) -> int:
        """Where the second of two spans begins, if the matches of one chain hold two; else 0."""
        last = max(start + length for start, _, length in matches)
        if last - matches[0][0] < 2 * self.min_cover * size:
            return 0
        spans = (c for c in _ends(size, matches, tight=True) if c[0] / size >= self.min_cover)
        if (first := next(spans, None)) is None:
            return 0
        second = _best(size, _between(matches, first[2] + 1))
        return second[1] if second[0] / size >= self.min_cover else 0

    def scan(self, data: bytes) -> tuple:
        words = words_of(data)
        known = self.vocabulary.get
        ids = np.array([known(w, 0) for w in words], np.int32)
        matches, places = self.anchors(ids)
        chains = {s: self.chains(s, found) for s, found in matches.items()}
        score = max([1.0 if places else 0.0, *[top for _, top in chains.values()]])
        spans = sorted((self.labels[s], *span) for s, (found, _) in chains.items() for span in found)
        starts = [p for p, _ in places]
        return (
            len(words),
            len(places),
            min(starts, default=None),
            max(starts, default=None),
            sorted({self.labels[s] for _, s in places}),
            spans,
            min(1.0, score),
        )


def scan(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    phrases: dict[str, tuple[str, ...]] = PHRASES,
    min_match: int = 3,
    min_cover: float = 0.7,
) -> DataFrame:
    """Base phrases and licence spans of ``docs`` (doc_id, text); word places count from 0."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases, min_match, min_cover)
        span = pa.struct(
            [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("coverage", pa.float64())]
        )
        kinds = (
            pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(span), pa.float64(),
        )
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "spans", "score"]
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 512):
                rows += [scanner.scan(t) for t in raw_texts(batch.column(1).slice(at, 512))]
            spans = [name.split(":")[0] for name in ("label", "first_word", "last_word", "coverage")]
            rows = [(*r[:5], [dict(zip(spans, s, strict=True)) for s in r[5]], r[6]) for r in rows]
            if rows:
                columns = [
                    pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *columns], names=["doc_id", *names]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, FOUND)
