"""Licence scan with a generalised suffix automaton over the words of licence texts.

All templates share one automaton. A file's words are streamed through it: after each word the state
and the states that its suffix links lead to say where in the templates the last words stand (matching
statistics). Every match of enough words that its place in a template does not go on from is a segment,
whether or not another place goes on. Segments that follow each other in file and template, with few
words between, are chained. A file's spans of a template are the chains without common words that cover
most, each charged with the words of a shortest segment, so that a chain is not cut for a repeated word.
Whole phrases are found by the same walk.

Spans of different templates may share words, as licences quote each other. Then the longer cover wins,
next the greater share, the earlier template, the earlier start; a span with words of a winner gives no label.

Rules: NULL and empty texts have no words and score 0; a label stands once however often it is found;
the score is the best share of a template that is covered, 1 for a whole phrase; extra columns are
ignored; repeated rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.texts import documents, slices

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of public licences and their usual notices, by label.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License"),
    ("mit", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("artistic", "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed. The intent is that the Copyright Holder maintains some artistic control over the development of that Package while still keeping the Package available as open source and free software."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]

#: Words of a segment at least; of a template, the share that a chain must cover; words left out between segments.
MIN_SEGMENT, MIN_COVER, MAX_GAP = 4, 0.6, 8

# Bytes of words: digits, letters (A-Z as a-z) and all of a character outside ASCII; the rest parts words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass
class Scan:
    """What a text holds: whole phrases (start, phrase), and per template its covered words and span."""

    n_words: int
    phrases: list[tuple[int, int]] = field(default_factory=list)
    spans: list[tuple[int, int, int, int]] = field(default_factory=list)  # template, covered, first word, after last
    wins: list[bool] = field(default_factory=list)  # whether a span holds its words against the others


class Automaton:
    """Suffix automaton of several word sequences; transitions by word, shared over all of them."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for number, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words, 1):
                last = self._extend(last, word, ends)
                ends[last].append((number, at))
        # A state's strings end wherever those of the states below it in the link tree do.
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                ends[self.link[state]] += ends[state]
        self.ends = [sorted(set(e)) for e in ends]

    def _new(self, length: int, ends: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append([])
        return len(self.next) - 1

    def _split(self, at: int, word: bytes, to: int, ends: list) -> int:
        """The state of the longest string at `at` with `word`, cut out of `to` where that holds longer ones."""
        if self.length[to] == self.length[at] + 1:
            return to
        clone = self._new(self.length[at] + 1, ends)
        self.next[clone], self.link[clone] = dict(self.next[to]), self.link[to]
        self.link[to] = clone
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def _extend(self, last: int, word: bytes, ends: list) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, word, known, ends)
        state = self._new(self.length[last] + 1, ends)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        self.link[state] = 0 if at < 0 else self._split(at, word, self.next[at][word], ends)
        return state


class Scanner:
    def __init__(self, phrases: list[str], templates: list[str], min_segment: int = MIN_SEGMENT, min_cover: float = MIN_COVER, max_gap: int = MAX_GAP):
        self.phrases = [words_of(p.encode()) for p in phrases]
        self.templates = [words_of(t.encode()) for t in templates]
        self.automaton = Automaton(self.phrases + self.templates)
        self.min_segment, self.min_cover, self.max_gap = min_segment, min_cover, max_gap
        self.shortest = min(map(len, self.phrases), default=1)
        count = len(self.phrases)
        # Phrases that end where a state's longest string does, with their length, by state.
        self.whole = [[(p, at) for p, at in e if p < count and at == len(self.phrases[p])] for e in self.automaton.ends]
        self.lineage = [self._lineage(s) for s in range(len(self.automaton.next))]
        self.places = [self._places(s) for s in range(len(self.automaton.next))]

    def _lineage(self, state: int) -> list[tuple[int, int]]:
        """Whole phrases that end in a state or in its suffixes."""
        found: dict[int, int] = {}
        while state > 0:
            for p, size in self.whole[state]:
                if size <= self.automaton.length[state]:
                    found[p] = size
            state = self.automaton.link[state]
        return sorted(found.items())

    def _places(self, state: int) -> list[tuple[int, list[tuple[int, int, bytes | None]]]]:
        """Along the suffix links, longest first: words matched at most, and the templates' places where
        no longer match ends, as (template, words up to here, word that follows there)."""
        out, seen, count = [], set(), len(self.phrases)
        while state > 0 and self.automaton.length[state] >= self.min_segment:
            own = [p for p in self.automaton.ends[state] if p[0] >= count and p not in seen]
            seen.update(own)
            held = ((number - count, end, self.templates[number - count]) for number, end in own)
            out.append((self.automaton.length[state], [(n, end, w[end] if end < len(w) else None) for n, end, w in held]))
            state = self.automaton.link[state]
        return out

    def scan(self, text: bytes) -> Scan:
        words = words_of(text)
        out = Scan(len(words))
        follow, link, length, lineage = self.automaton.next, self.automaton.link, self.automaton.length, self.lineage
        segments: dict[int, list[tuple[int, int, int]]] = {}
        state = matched = 0
        start_of = follow[0]
        for at, word in enumerate(words):
            if not state:
                # Outside of any match only a first word that templates have matters.
                to = start_of.get(word)
                if to is not None:
                    state, matched = to, 1
                    self._note(lineage[state], matched, at, out)
                continue
            to = follow[state].get(word)
            if matched >= self.min_segment:
                self._segment(state, matched, at, word, segments)
            if to is None:
                while state and to is None:
                    state = link[state]
                    matched = length[state]
                    to = follow[state].get(word)
                if to is None:
                    state = matched = 0
                    continue
            state, matched = to, matched + 1
            if lineage[state]:
                self._note(lineage[state], matched, at, out)
        if matched >= self.min_segment:
            self._segment(state, matched, len(words), None, segments)
        for template, own in sorted(segments.items()):
            out.spans += self._chains(template, own)
        out.wins = self._winners(out.spans)
        return out

    @staticmethod
    def _note(found: list[tuple[int, int]], matched: int, at: int, out: Scan) -> None:
        out.phrases += [(at - size + 1, p) for p, size in found if size <= matched]

    def _segment(self, state: int, matched: int, after: int, word: bytes | None, segments: dict) -> None:
        """Notes the matches up to here whose place in a template `word` does not go on from."""
        for longest, places in self.places[state]:
            size = min(matched, longest)
            if size < self.min_segment:
                break
            for template, end, follows in places:
                if word is None or follows != word:
                    segments.setdefault(template, []).append((after - size, end - size, size))

    def _chains(self, template: int, segments: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Chains of a template's segments (file start, template start, length), in file order, without
        common words, that cover most; each is charged with the words of a shortest segment.

        A segment follows one that starts and ends before it in file and template, each at most the gap
        away; words that both hold count once. Only segments within reach are looked at, so the work
        follows their number however long the file is.
        """
        segments = sorted(segments)
        reach = len(self.templates[template]) + self.max_gap
        by_end = sorted(range(len(segments)), key=lambda k: sum(segments[k][::2]))
        # Per segment, of the best choice that ends with it: value, words covered; segment before, and whether in its chain.
        best: list[tuple[int, int]] = []
        before: list[tuple[int, bool]] = []
        done, top, top_at = 0, (0, 0), -1
        first = 0
        for k, (f, t, n) in enumerate(segments):
            while done < len(by_end) and sum(segments[by_end[done]][::2]) <= f:
                if best[by_end[done]] > top:
                    top, top_at = best[by_end[done]], by_end[done]
                done += 1
            value, source = (top[0] + n - self.min_segment, top[1] + n), (top_at, False)
            while segments[first][0] + reach < f:
                first += 1
            for j in range(first, k):
                g, u, m = segments[j]
                if g < f and u < t and g + m < f + n and u + m < t + n and f - (g + m) <= self.max_gap and t - (u + m) <= self.max_gap:
                    gain = n - max(0, g + m - f, u + m - t)
                    if (best[j][0] + gain, best[j][1] + gain) > value:
                        value, source = (best[j][0] + gain, best[j][1] + gain), (j, True)
            best.append(value)
            before.append(source)
        out = []
        k = max(range(len(segments)), key=lambda i: (best[i], -i), default=-1)
        while k >= 0:
            last, covered = k, best[k][1]
            while before[k][1]:
                k = before[k][0]
            start, k = segments[k][0], before[k][0]
            out.append((template, covered - (best[k][1] if k >= 0 else 0), start, sum(segments[last][::2])))
        return out[::-1]

    def _winners(self, spans: list[tuple[int, int, int, int]]) -> list[bool]:
        wins, held = [False] * len(spans), []  # held: winners' (start, after) in file order
        for k in sorted(range(len(spans)), key=lambda i: (-spans[i][1], -spans[i][1] / len(self.templates[spans[i][0]]), spans[i][0], spans[i][2])):
            start, after = spans[k][2:]
            at = bisect(held, (start, after))
            if (at == 0 or held[at - 1][1] <= start) and (at == len(held) or held[at][0] >= after):
                held.insert(at, (start, after))
                wins[k] = True
        return wins


_scanners: dict[tuple, Scanner] = {}


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, **limits) -> DataFrame:
    """(doc_id, n_words, places, spans): whole phrases (start word, label) and template spans
    (label, template, covered share, first word, word after the last, whether it wins over those with the same words)."""
    names, labels = list(phrases), list(phrases.values())
    marks, passages = [n for n, _ in templates], [t for _, t in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tuple(names), tuple(passages), tuple(sorted(limits.items())))
        if key not in _scanners:
            _scanners[key] = Scanner(names, passages, **limits)
        own = _scanners[key]
        for batch in batches:
            for part in slices(batch):
                counts, places, spans = [], [], []
                for text in part.column("text").cast(pa.large_binary()).to_pylist():
                    found = own.scan(text or b"")
                    counts.append(found.n_words)
                    places.append([{"start": s, "label": labels[p]} for s, p in sorted(found.phrases)])
                    spans.append([
                        {"label": marks[t], "template": t, "share": min(1.0, c / len(own.templates[t])), "start": a, "end": b, "wins": w}
                        for (t, c, a, b), w in zip(found.spans, found.wins)
                    ])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(places, _PLACES), pa.array(spans, _SPANS)],
                    ["doc_id", "n_words", "places", "spans"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, _SCANNED)


_PLACES = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("share", pa.float64()), ("start", pa.int64()), ("end", pa.int64()), ("wins", pa.bool_())]))
_SCANNED = (
    "doc_id bigint, n_words bigint, places array<struct<start:bigint,label:string>>, "
    "spans array<struct<label:string,template:int,share:double,start:bigint,end:bigint,wins:boolean>>"
)


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    starts, base = F.transform("places", lambda x: x["start"]), F.transform("places", lambda x: x["label"])
    covered = F.transform(F.filter("spans", lambda s: s["wins"] & (s["share"] >= MIN_COVER)), lambda s: s["label"])
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, covered))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
