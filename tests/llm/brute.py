"""Plain single-process versions of the text operators, to compare with."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    inside = set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            inside.update(range(i, i + 5))
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": dup,
        "n_repeat_words": len(inside),
    }


def without_common_lines(rows, min_chars=40, min_docs=5):
    """(doc_id, n_lines, n_dropped, kept text) of each row."""
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(_LOWER)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    common = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in common or common[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def simhash(text, shingle=3):
    words = WORD.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def linked(n, links):
    """The smallest member of each place's component."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def near_links(prints, radius):
    prints = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius):
            yield i, i + 1 + int(j)


def segmentation_tokens(pretoken, scores, longest=128):
    data = pretoken.encode()
    best = [(0.0, 0)]
    for end in range(1, len(data) + 1):
        ways = [
            (best[start][0] + scores[data[start:end]], -(best[start][1] + 1))
            for start in range(max(0, end - longest), end)
            if data[start:end] in scores
        ]
        score, tokens = max(ways)
        best.append((score, -tokens))
    return best[-1][1]


def jaccard(a, b, shingle=5):
    a, b = (
        {" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} for w in (WORD.findall(x.lower()) for x in (a, b))
    )
    return len(a & b) / len(a | b)


def kept_by_jaccard(rows, least=0.8):
    """What brute force leaves of texts without copies: the smallest id of each group."""
    rows = sorted(rows)
    near = [
        (i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if jaccard(rows[i][1], rows[j][1]) >= least
    ]
    return {rows[root][0] for root in linked(len(rows), near)}
