"""Finding license texts by patience alignment.

A text and a license are sequences of words. Words that occur once in both are
anchors; the longest increasing subsequence of their places orders them, and
the gaps between them are aligned the same way. Coverage is the share of the
license's words that are aligned. Runs equal at either end of a gap are matched
first, so words that repeat inside a gap are reached too.

Where to align: a license that is covered to the threshold must share one of its
words that are rarest in the text, so each of their places is aligned with a
window around it, and a license whose rare words are absent is done with. The
windows have the length of the license at first. Around places that are in no
finding they are doubled up to the whole text, so words inserted into a license
(page headers, other columns, a clause) do not hide it, however many. Wide
windows begin and end at multiples of their slack, so all of one width cost no
more than a few passes. In them aligned words have to stand in runs of RUN on
average: single words scattered over a long text are no license.

Defined cases: a null or empty text has no license; a license repeated in a text
is a row each time; overlapping findings of one license are one, the best
covered; rows are independent, so repeated rows, nulls and other columns have no
effect; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabloom.llm.common import texts

WORD = re.compile(r"\w+")
#: Aligned words per uninterrupted run, on average, of a finding in a wide window.
RUN = 3

#: Notices and short licenses as published.
LICENSES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence that rises in both places; pairs come in order of the first."""
    ends, places, before = [], [], []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(ends, b)
        before.append(places[k - 1] if k else -1)
        if k == len(ends):
            ends.append(b)
            places.append(i)
        else:
            ends[k], places[k] = b, i
    chain, i = [], places[-1] if places else -1
    while i >= 0:
        chain.append(pairs[i])
        i = before[i]
    return chain[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of aligned words, in rising order; gaps wait on a stack, not in nested calls."""
    matched, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = _rising([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place])
        matched.extend(anchors)
        if anchors:
            edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            gaps.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]))
    return sorted(matched)


def _runs(pairs: list[tuple[int, int]]) -> int:
    """Runs of pairs that follow each other in both."""
    return 1 + sum((i + 1, j + 1) != after for (i, j), after in zip(pairs, pairs[1:]))


class License:
    def __init__(self, text: str, threshold: float):
        self.words = words_of(text)
        self.counts = Counter(self.words)
        self.places = defaultdict(list)
        for j, word in enumerate(self.words):
            self.places[word].append(j)
        #: Aligned words a finding has; so many others may be missing.
        self.needed = max(1, -int(-threshold * len(self.words) // 1))
        self.spare = len(self.words) - self.needed

    def keys(self, counts: Counter) -> list[str] | None:
        """Words of which a covered text has one: the rarest in it that do not fit into what may be missing."""
        found = sum(min(n, counts[w]) for w, n in self.counts.items())
        if found < self.needed:
            return None
        chosen, total = [], 0
        for word in sorted(self.counts, key=lambda w: (counts[w] / self.counts[w], w)):
            chosen.append(word)
            total += self.counts[word]
            if total > self.spare:
                break
        return chosen


def _grown(words: list[str], own: License, taken: list, n: int, first: int, last: int, runs: int, slack: int) -> tuple:
    """Aligned words, first and last place of a finding, with what lies beyond its window in runs of its own."""
    while n < len(own.words):
        k = taken.index((first, last))
        slack *= 2
        low = max(first - slack, taken[k - 1][1] + 1 if k else 0)
        high = min(last + slack, taken[k + 1][0] if k + 1 < len(taken) else len(words))
        pairs = align(words[low:high], own.words)
        more = len(pairs) - n
        if more < RUN or more < RUN * (_runs(pairs) - runs):
            break
        n, first, last, runs = len(pairs), low + pairs[0][0], low + pairs[-1][0], _runs(pairs)
        taken[k] = (first, last)
    return n, first, last


def scan(text: str, licenses: dict[str, License]) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, first character, end, aligned words) of each finding."""
    lowered = text.lower()
    words = WORD.findall(lowered)
    counts, spans, places, found = Counter(words), None, None, []
    for name, own in licenses.items():
        keys = own.keys(counts)
        if keys is None:
            continue
        if places is None:
            places = defaultdict(list)
            wanted = set().union(*[x.counts for x in licenses.values()])
            for i, word in enumerate(words):
                if word in wanted:
                    places[word].append(i)
        slack = base = max(2, len(own.words) // 4)
        taken: list[tuple[int, int]] = []
        tried = set()
        while True:
            hits = []
            for key in keys:
                for i in places[key]:
                    k = bisect_left(taken, (i + 1,))
                    if k and taken[k - 1][1] >= i:
                        continue
                    low = taken[k - 1][1] + 1 if k else 0
                    high = taken[k][0] if k < len(taken) else len(words)
                    for j in own.places[key]:
                        start, end = i - j - slack, i - j + len(own.words) + slack
                        if slack > base:
                            start, end = start // slack * slack, -(-end // slack) * slack
                        start, end = max(low, start), min(high, end)
                        if (start, end) in tried:
                            continue
                        tried.add((start, end))
                        window = words[start:end]
                        if sum((Counter(window) & own.counts).values()) < own.needed:
                            continue
                        pairs = align(window, own.words)
                        if len(pairs) < own.needed or slack > base and len(pairs) < RUN * _runs(pairs):
                            continue
                        hits.append((len(pairs), -(start + pairs[0][0]), start + pairs[-1][0], _runs(pairs)))
            fresh = []
            for n, first, last, runs in sorted(hits, reverse=True):
                if all(last < a or -first > b for a, b in taken):
                    insort(taken, (-first, last))
                    fresh.append((n, -first, last, runs))
            for n, first, last, runs in fresh:
                n, first, last = _grown(words, own, taken, n, first, last, runs, slack)
                if spans is None:  # places in the text as it is, if lowering it has moved none
                    spans = [m.span() for m in WORD.finditer(lowered if len(lowered) == len(text) else text)]
                    spans = spans if len(spans) == len(words) else [m.span() for m in WORD.finditer(lowered)]
                found.append((name, n / len(own.words), spans[first][0], spans[last][1], n))
            if slack >= len(words):
                break
            slack *= 2
    return found


def find_licenses(
    docs: DataFrame, licenses: dict[str, str] | None = None, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per finding: ``doc_id``, ``license``, ``coverage``, ``start_char``, ``end_char``, ``n_aligned``."""
    documents = texts(docs, id_col, text_col)
    known = {name: License(text, threshold) for name, text in (LICENSES if licenses is None else licenses).items()}
    fields = [("license", T.StringType()), ("coverage", T.DoubleType())]
    fields += [(n, T.LongType()) for n in ("start_char", "end_char", "n_aligned")]
    schema = T.StructType([documents.schema["doc_id"]] + [T.StructField(*f) for f in fields])
    types = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(1)):
                hits = scan(text.as_py(), known)
                rows.extend([i] * len(hits))
                found.extend(hits)
            columns = [pa.array([f[k] for f in found], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], schema.names)

    return documents.mapInArrow(run, schema)
