"""Licence texts in documents, by a generalised suffix automaton of licence words."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from subscore.llm.text import append_columns, words_of

#: Phrases and the labels that they give.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

#: Wording of well-known licences and of the notices that point to them. Callers may
#: pass others, or these and more.
TEMPLATES = [
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "artistic",
        "This package is free software; you can redistribute it and/or modify it under the terms "
        "of the Artistic License version 2.0.",
    ),
    (
        "boost",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        "Software) to use, reproduce, display, distribute, execute, and transmit the Software, "
        "and to prepare derivative works of the Software, and to permit third-parties to whom "
        "the Software is furnished to do so",
    ),
    ("boost", "Distributed under the Boost Software License, Version 1.0."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "bsd-3",
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ),
    (
        "bsd-4",
        "All advertising materials mentioning features or use of this software must display the "
        "following acknowledgement",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ),
    (
        "epl",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    ),
    (
        "eupl",
        "Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European "
        "Commission subsequent versions of the EUPL",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("mit", "Released under the MIT License."),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means.",
    ),
    (
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software.",
    ),
]

#: Words of templates and phrases; the automaton of more would be too large for every worker.
MOST_WORDS = 100_000

PLACE = StructType(
    [
        StructField("label", StringType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
    ]
)
SPAN = StructType([*PLACE.fields, StructField("coverage", DoubleType())])


class SuffixAutomaton:
    """All word runs of several texts; ``ends`` lists where the runs of a state end in them."""

    def __init__(self, texts: Sequence[Sequence[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        for number, words in enumerate(texts):
            last = 0
            for end, word in enumerate(words):
                last = self._extend(last, word, own)
                own[last].append((number, end))
        self.ends = [set(x) for x in own]
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]

    def _extend(self, last: int, word: bytes, own: list) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known, own)
        new = self._state(self.length[last] + 1, {}, own)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last < 0:
            self.link[new] = 0
        else:
            known = self.next[last][word]
            if self.length[known] == self.length[last] + 1:
                self.link[new] = known
            else:
                self.link[new] = self._split(last, word, known, own)
        return new

    def _split(self, last: int, word: bytes, known: int, own: list) -> int:
        """A state for the shorter runs of ``known``, those that end with ``word`` after ``last``."""
        copy = self._state(self.length[last] + 1, dict(self.next[known]), own)
        self.link[copy], self.link[known] = self.link[known], copy
        while last >= 0 and self.next[last].get(word) == known:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def _state(self, length: int, following: dict, own: list) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        own.append([])
        return len(self.link) - 1


class LicenseScanner:
    """Matching statistics of a text's words against all phrases and templates."""

    def __init__(self, phrases, templates, shortest: int, gap: int, coverage: float):
        self.phrases = [(label, words_of(text.encode())) for label, text in phrases]
        self.templates = [(label, words_of(text.encode())) for label, text in templates]
        self.shortest, self.gap, self.coverage = shortest, gap, coverage
        self.automaton = SuffixAutomaton([w for _, w in self.templates + self.phrases])
        self.vocabulary = {w for follow in self.automaton.next for w in follow}
        #: the phrases that the longest run of each state ends with
        self.phrase_ends: list[list[int]] = [[] for _ in self.automaton.next]
        for number, (_, words) in enumerate(self.phrases):
            state = 0
            for word in words:
                state = self.automaton.next[state][word]
            self.phrase_ends[state].append(number)
        for state in sorted(range(1, len(self.phrase_ends)), key=self.automaton.length.__getitem__):
            self.phrase_ends[state] += self.phrase_ends[self.automaton.link[state]]

    def scan(self, words: list[bytes]):
        """(places of phrases, chained template spans) of one text."""
        vocabulary, a = self.vocabulary, self.automaton
        places, matches = [], []
        state = length = 0
        before = -2
        for at in [n for n, word in enumerate(words) if word in vocabulary]:
            word = words[at]
            if at != before + 1:
                state = length = 0
            before = at
            while state and word not in a.next[state]:
                state = a.link[state]
                length = a.length[state]
            following = a.next[state].get(word)
            if following is None:
                state = length = 0
                continue
            state, length = following, length + 1
            if length >= self.shortest:
                then = words[at + 1] if at + 1 < len(words) else None
                matches += self.ending(at, state, length, then)
            for phrase in self.phrase_ends[state]:
                label, run = self.phrases[phrase]
                if len(run) <= length:
                    places.append((label, at - len(run) + 1, at + 1))
        return sorted(places, key=lambda p: p[1:]), self.chains(matches)

    def ending(self, at: int, state: int, length: int, then: bytes | None):
        """(start, length, template, place in it) of all matches that go up to ``at`` and no further.

        Suffix links lead to shorter runs, which other places and templates hold; each place
        counts with the longest run that ends there, unless ``then`` goes on with it.
        """
        a, seen, found = self.automaton, set(), []
        while state and length >= self.shortest:
            for number, end in a.ends[state] - seen:
                if number < len(self.templates):
                    words = self.templates[number][1]
                    if end + 1 == len(words) or words[end + 1] != then:
                        found.append((at - length + 1, length, number, end - length + 1))
            seen = a.ends[state]
            state = a.link[state]
            length = a.length[state]
        return found

    def chains(self, matches: list[tuple[int, int, int, int]]):
        """Matches in the order of a template, ``gap`` words apart at most, as spans."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for start, length, number, place in matches:
            by_template.setdefault(number, []).append((start, length, place))
        spans = []
        for number, found in by_template.items():
            label, words = self.templates[number]
            chains = []  # (start, end in text, end in template, covered)
            open_from = 0
            for start, length, place in sorted(found):
                best = (start, start + length, place + length, length)
                while open_from < len(chains) and chains[open_from][1] < start - self.gap - len(words):
                    open_from += 1
                for first, end, reached, covered in chains[open_from:]:
                    # A match may begin inside the one before it; only its rest counts.
                    inside = max(0, end - start, reached - place)
                    if inside < length and start - end <= self.gap and reached <= place + inside:
                        if covered + length - inside > best[3]:
                            best = (first, start + length, place + length, covered + length - inside)
                chains.append(best)
            chosen_end = -1
            for first, end, _, covered in sorted(chains, key=lambda c: (c[0], -c[3], c[1])):
                if covered >= self.coverage * len(words) and first >= chosen_end:
                    spans.append((label, first, end, covered / len(words)))
                    chosen_end = end
        return sorted(set(spans), key=lambda s: (s[1], s[2], s[0], s[3]))


def license_spans(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    shortest: int = 3,
    gap: int = 8,
    coverage: float = 0.8,
    text: str = "text",
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, phrase ``places`` and template ``spans``, as word positions.

    ``places`` (label, start, end) are all places where the words of a phrase stand one after
    the other. ``spans`` (label, start, end, coverage) are chains of matches of at least
    ``shortest`` words that follow each other in text and template, at most ``gap`` words
    apart, and cover the share ``coverage`` of a template's words. Every text, however long, is
    streamed once through the automaton of all phrases and templates, which is broadcast as
    their text; more than 100,000 words of them are refused.

    Null and empty texts have no words, places or spans. Repeated rows come out as often as
    they came in; an empty table gives an empty table. Columns of ``docs`` (``keep``: only
    these) stay, except that the three new ones replace columns of these names.
    """
    n_words = sum(len(words_of(own.encode())) for _, own in (*phrases, *templates))
    if n_words > MOST_WORDS:
        raise ValueError(f"{n_words} words of templates are more than {MOST_WORDS}")
    shared = docs.sparkSession.sparkContext.broadcast({"texts": (list(phrases), list(templates))})

    def prepare():
        value = shared.value
        scanner = value.get("scanner")
        if scanner is None:
            scanner = value["scanner"] = LicenseScanner(*value["texts"], shortest, gap, coverage)

        def compute(texts):
            counts, places, spans = [], [], []
            for document in texts:
                words = words_of(document)
                found, chained = scanner.scan(words)
                counts.append(len(words))
                places.append([{"label": x, "start": s, "end": e} for x, s, e in found])
                spans.append(
                    [{"label": x, "start": s, "end": e, "coverage": c} for x, s, e, c in chained]
                )
            place = [("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
            span = pa.struct([*place, ("coverage", pa.float64())])
            return (
                pa.array(counts, pa.int64()),
                pa.array(places, pa.list_(pa.struct(place))),
                pa.array(spans, pa.list_(span)),
            )

        return compute

    added = [("n_words", LongType()), ("places", ArrayType(PLACE)), ("spans", ArrayType(SPAN))]
    return append_columns(docs, text, keep, added, prepare)
