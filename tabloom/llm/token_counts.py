"""Counting unigram tokens of texts with a trie of pre-tokens.

A text is split by a pattern; the best segmentation of a pre-token into pieces
of a vocabulary, by the sum of their scores, gives its number of tokens. Distinct
pre-tokens go into a trie: the forward score of a node, the best segmentation of
the bytes from the root, is computed once for all pre-tokens that share the
prefix, and the count of a whole pre-token is kept at its node. Texts then add
up the counts of their pre-tokens. A task has one trie, which is started anew
when it has MOST_NODES nodes; that costs time and changes no result. Nothing is
shuffled, so a frequent word or a large source is no burden for any one task.

Scores are log probabilities of pieces by their rank in a public vocabulary
(Zipf's law), or any given scores; nothing is trained.

Defined cases: a null or empty text has no tokens; of equally good segmentations
the one with fewer tokens counts; a byte that is no piece is one token of the
lowest score; rows are independent, so repeated rows, nulls and other columns
have no effect; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabloom.llm.common import MAYBE_BLANK, texts

MOST_NODES = 1_000_000
#: Characters of a pre-token from which it is scored outside the trie.
IN_TRIE = 4096
#: Characters of text that are split at once.
BLOCK = 1 << 16


def zipf_scores(ranks: str) -> dict[bytes, float]:
    """log(1 / (rank + 1)) for each piece of a rank file, up to a constant."""
    with open(ranks, "rb") as lines:
        return {base64.b64decode(piece): -math.log(int(rank) + 1) for piece, rank in map(bytes.split, lines)}


class PieceTrie:
    """Forward scores of prefixes, as parallel lists indexed by node; node 0 is the empty prefix.

    A second trie holds the pieces backwards, so the pieces that end a prefix
    are found by walking it along the prefix's last bytes.
    """

    def __init__(self, scores: dict[bytes, float]):
        self.lowest = min(scores.values(), default=0.0) - 1.0
        self.longest = max(map(len, scores), default=1)
        self.endings: dict = {}
        for piece, score in scores.items():
            node = self.endings
            for byte in reversed(piece):
                node = node.setdefault(byte, {})
            node[-1] = score
        self.clear()

    def clear(self) -> None:
        self.children: list[dict | None] = [None]
        self.parent, self.byte = [0], [0]
        self.best, self.tokens = [0.0], [0]
        self.counts: dict[str, int] = {}

    def _add(self, parent: int, byte: int) -> int:
        """A new node: the best last piece of its prefix, given the scores of shorter prefixes."""
        node = len(self.best)
        above, last, ending = parent, byte, self.endings
        best, fewest = self.best[parent] + self.lowest, self.tokens[parent] + 1
        found = False
        while True:
            ending = ending.get(last)
            if ending is None:
                break
            score = ending.get(-1)
            if score is not None:
                total, count = self.best[above] + score, self.tokens[above] + 1
                if not found or total > best or (total == best and count < fewest):
                    best, fewest, found = total, count, True
            if above == 0:
                break
            last, above = self.byte[above], self.parent[above]
        self.children.append(None)
        self.parent.append(parent)
        self.byte.append(byte)
        self.best.append(best)
        self.tokens.append(fewest)
        if self.children[parent] is None:
            self.children[parent] = {}
        self.children[parent][byte] = node
        return node

    def _rolled(self, data: bytes) -> int:
        """As the trie would find it, with the scores of the last prefixes only; memory does not follow the length."""
        size = self.longest + 1
        best, tokens = [0.0] * size, [0] * size
        for end in range(1, len(data) + 1):
            before = (end - 1) % size
            top, fewest = best[before] + self.lowest, tokens[before] + 1
            found, ending, at = False, self.endings, end
            while at > 0:
                ending = ending.get(data[at - 1])
                if ending is None:
                    break
                at -= 1
                score = ending.get(-1)
                if score is not None:
                    total, count = best[at % size] + score, tokens[at % size] + 1
                    if not found or total > top or (total == top and count < fewest):
                        top, fewest, found = total, count, True
            best[end % size], tokens[end % size] = top, fewest
        return tokens[len(data) % size]

    def insert(self, pretoken: str) -> int:
        """The number of tokens of the best segmentation, kept for the next time unless the pre-token is very long."""
        if len(pretoken) > IN_TRIE:
            return self._rolled(pretoken.encode())
        node = 0
        for byte in pretoken.encode():
            children = self.children[node]
            following = children.get(byte) if children else None
            node = self._add(node, byte) if following is None else following
        count = self.counts[pretoken] = self.tokens[node]
        return count

    def total(self, pretokens: list[str]) -> int:
        counts, long = self.counts, {}
        for new in set(pretokens).difference(counts):
            found = self.insert(new)
            if new not in counts:
                long[new] = found
        if not long:
            return sum(map(counts.__getitem__, pretokens))
        return sum(long[x] if x in long else counts[x] for x in pretokens)


@lru_cache(maxsize=2)
def _trie(ranks: str) -> PieceTrie:
    return PieceTrie(zipf_scores(ranks))


def split(text: str, pattern, size: int = BLOCK):
    """Lists of pre-tokens; a long text is cut where no match can span, so memory does not follow its length."""
    import regex

    safe = regex.compile(f"[^{MAYBE_BLANK}](?=[ \\n\\t\\r])")
    start = 0
    while len(text) - start > size:
        end = safe.search(text, start + size)
        if end is None:
            break
        yield pattern.findall(text, start, end.end())
        start = end.end()
    yield pattern.findall(text, start)


def count_tokens(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_pretokens`` and ``n_tokens``."""
    documents = texts(docs, id_col, text_col)
    schema = T.StructType(
        [documents.schema["doc_id"], T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def run(batches):
        import regex

        compiled, trie = regex.compile(pattern), _trie(ranks)
        for batch in batches:
            words, pieces = [], []
            for text in batch.column(1):
                n = tokens = 0
                for part in split(text.as_py(), compiled):
                    if len(trie.best) > MOST_NODES:
                        trie.clear()
                    n += len(part)
                    tokens += trie.total(part)
                words.append(n)
                pieces.append(tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(pieces, pa.int64())], schema.names
            )

    return documents.mapInArrow(run, schema)
