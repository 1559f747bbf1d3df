"""Best-fit packing of documents into training sequences.

Tasks tokenize whole texts with the tokenizers library. A document longer than
a sequence is cut into full pieces, the first one shorter; full pieces are
sequences of their own. The other pieces are packed by best-fit decreasing: a
segment tree over remaining capacities finds the tightest open sequence in
logarithmic time. Pieces are dealt to shards of a bounded number of pieces, each
packed by one task. Sequences that a shard leaves rather empty are opened again
and packed with those of other shards, round by round, until one shard is left;
so shards cost hardly any sequences, and no task sees more than its shard.

Words repeat, so a task remembers the ids of text between blanks and punctuation.
Texts are cut there as byte ranges of an Arrow column, so a word costs Python once
for all its places in some megabytes of text. The memory has two generations of
bounded size; what is forgotten is encoded again.

Defined cases: a null or empty text is the separator alone, a piece of one
token; rows are independent documents even if they repeat; an empty table gives
an empty result; other columns have no effect.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm.common import BLANKS, MAYBE_BLANK, distinct, row_groups, stretches, texts, utf8
from tabloom.sources.workspace import materialized

#: Pieces that one task packs.
SHARD = 8192
#: A sequence filled to this share is final.
FULL = 0.98
#: Words a worker remembers in each of two generations.
REMEMBERED = 400_000

#: Bytes of text that are cut at once.
TEXT = 1 << 22

#: Kinds of bytes: letters and digits, marks, blanks (all ASCII), and the rest.
_REST, _WORD, _MARK, _BLANK = range(4)
_KINDS = np.array(
    [_BLANK if chr(i) in BLANKS else _REST if not 32 < i < 127 else _WORD if chr(i).isalnum() else _MARK for i in range(256)],
    np.uint8,
)
_MAYBE_BLANK = re.compile(f"[{MAYBE_BLANK}]")
#: The bytes of each character beyond ASCII that may be white space, as a number.
_WIDE_BLANKS = [
    int.from_bytes(chr(i).encode())
    for i in range(0x80, 0x10000)
    if not 0xD800 <= i < 0xE000 and _MAYBE_BLANK.match(chr(i))
]
#: Whether there is a cut between two bytes, by 4 * kind + kind.
_CUTS = np.isin(np.arange(16), [4 * _WORD + _MARK, 4 * _WORD + _BLANK, 4 * _MARK + _BLANK])


def _ends_in_blank(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether what may be white space (``MAYBE_BLANK``) ends before each place; the byte there is not ASCII."""
    one, two, three = (data[np.maximum(places - i, 0)].astype(np.int64) for i in (1, 2, 3))
    return np.isin(two << 8 | one, _WIDE_BLANKS) | np.isin(three << 16 | two << 8 | one, _WIDE_BLANKS)


def _may_end_blank(unit: bytes) -> bool:
    if unit[-1] < 0x80:
        return _KINDS[unit[-1]] in (_BLANK, _REST)
    return _MAYBE_BLANK.match(unit.decode()[-1]) is not None


def cut_units(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts in units that have the same ids wherever they stand, and where the units of each text begin and end.

    The byte-level splitting pattern has letters, digits and marks in runs of
    their own, each with at most one blank before it. So no match spans the
    place before an ASCII blank that follows something other than white space,
    nor that between an ASCII letter or digit and a mark. One blank that is not
    a space is a match of its own between things that are not white space.
    """
    data, starts = utf8(column)
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        kinds = _KINDS[data]
        cut[1:-1] = _CUTS[4 * kinds[:-1] + kinds[1:]]
        beyond = np.flatnonzero((kinds[1:] == _BLANK) & (data[:-1] >= 0x80)) + 1
        cut[beyond[~_ends_in_blank(data, beyond)]] = True
        cut[starts] = True
        lone = np.flatnonzero(cut[:-2] & (kinds[:-1] == _BLANK) & (data[:-1] != 0x20) & (kinds[1:] != _BLANK) & (kinds[1:] != _REST))
        cut[lone + 1] = True
    begins = np.flatnonzero(cut)
    return stretches(data, np.diff(begins)), np.searchsorted(begins, starts)


class WordIds:
    """Ids of texts by a tokenizers file, as little-endian unsigned 32-bit bytes.

    Ids of units are remembered; new units are encoded together.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.remembered = remembered
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            lengths[i] = len(token)  # one character for each byte
        self.lengths = lengths

    def _learn(self, units: list[bytes]) -> None:
        # a unit with a space before it and something else than white space at its end can stand between others like it
        inner = [u for u in units if u[0] == 32 and not _may_end_blank(u)]
        # a line feed alone between other things is one token, so that words without a space can stand between others, too
        lines = [u for u in units if _KINDS[u[0]] == _WORD and not _may_end_blank(u)]
        others = set(units).difference(inner, lines)
        for kind, before in ((inner, b""), (lines, b"\n")):
            for start in range(0, len(kind), 2000):
                group = kind[start : start + 2000]
                ids = np.array(self._ids(b"".join([before + u for u in group])), "<u4")
                ends = np.cumsum(self.lengths[ids])
                wanted = np.cumsum([len(before + u) for u in group])
                cuts = np.searchsorted(ends, wanted)
                firsts = np.r_[0, cuts[:-1] + 1]
                if cuts[-1] >= len(ends) or not np.array_equal(ends[cuts], wanted) or (before and (self.lengths[ids[firsts]] != 1).any()):
                    others.update(group)  # cannot happen while the pattern keeps blanks apart
                    continue
                raw = ids.tobytes()
                for unit, first, cut in zip(group, (4 * (firsts + len(before))).tolist(), (4 * (cuts + 1)).tolist()):
                    self.young[unit] = raw[first:cut]
        rest = sorted(others)
        batch = self.tokenizer.encode_batch_fast([u.decode() for u in rest], add_special_tokens=False)
        self.young.update(zip(rest, [np.array(e.ids, "<u4").tobytes() for e in batch]))

    def _ids(self, text: bytes) -> list[int]:
        return self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids

    def of(self, batch) -> list[bytes]:
        """Ids of each text of a list or an Arrow column."""
        column = batch if isinstance(batch, pa.Array) else pa.array(batch, pa.string())
        units, bounds = cut_units(column)
        words, which = distinct(units)
        if len(self.young) > self.remembered:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in unknown:
            known = self.old.get(words[i])
            if known is None:
                new.append(words[i])
            else:
                self.young[words[i]] = known
        self._learn(new)
        for i in unknown:
            found[i] = self.young[words[i]]
        joined = pa.array(found, pa.binary()).take(pa.array(which))
        raw, places = utf8(joined)
        raw, ends = raw.tobytes(), places[bounds].tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_pieces(
    docs: DataFrame, tokenizer: str, size: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length`` and ``ids`` (binary, unsigned 32-bit)."""
    documents = texts(docs, id_col, text_col)
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = int(separator).to_bytes(4, "little")

    def cut(batches):
        own = _word_ids(tokenizer)
        for batch in batches:
            ids, words = batch.column(0), batch.column(1)
            first = 0
            for group in row_groups(words, TEXT):
                row, piece, start, length, raw = [], [], [], [], []
                for i, tokens in enumerate(own.of(group)):
                    tokens += end
                    n, begin, k = len(tokens) // 4, 0, 0
                    stop = n % size or size
                    while begin < n:
                        row.append(first + i)
                        piece.append(k)
                        start.append(begin)
                        length.append(stop - begin)
                        raw.append(tokens[4 * begin : 4 * stop])
                        begin, stop, k = stop, stop + size, k + 1
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(raw, pa.binary())], schema.names,
                )
                first += len(group)

    return documents.mapInArrow(cut, schema)


class OpenBins:
    """Open sequences by remaining capacity, under a segment tree.

    A leaf holds the sequences with just that much room, a node how many lie
    below it; the tightest fit for a length is the first non-empty leaf at or
    after it.
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The room and number of the tightest sequence with at least this room, taken out."""
        count, node = self.count, self.leaves + length
        if not count[node]:
            while node & 1 or not count[node + 1]:  # up, until a right sibling holds something
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths, size: int) -> tuple[list[int], list[int], list[int]]:
    """Sequence and offset of each length, and how full each sequence is."""
    order = np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist()
    bins, filled = OpenBins(size), []
    number, offset = [0] * len(order), [0] * len(order)
    for i in order:
        length = int(lengths[i])
        found = bins.take(length)
        room, b = found or (size, len(filled))
        if found is None:
            filled.append(0)
        number[i], offset[i] = b, size - room
        filled[b] += length
        if room > length:
            bins.put(room - length, b)
    return number, offset, filled


def _pack_shards(pieces: DataFrame, size: int, first_id: int) -> DataFrame:
    schema = T.StructType(
        pieces.schema.fields
        + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset", "filled")]
    )

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        ties = table.column("row").to_numpy()
        table = table.take(pa.array(np.lexsort((ties, -lengths))))  # the same result however rows arrive
        number, offset, filled = best_fit_decreasing(table.column("length").to_numpy(), size)
        shard = table.column("shard")[0].as_py()
        number, filled = np.array(number, np.int64), np.array(filled, np.int64)
        added = [first_id + (shard << 32) + number, np.array(offset, np.int64), filled[number]]
        for name, values in zip(("sequence_id", "offset", "filled"), added):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    return pieces.groupBy("shard").applyInArrow(pack, schema)


def pack(pieces: DataFrame, size: int = 2048, shard: int = SHARD, full: float = FULL) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; each row has a ``length`` of 1 to ``size``.

    Any other columns go along, under names other than ``row``, ``shard`` and ``filled``. Every piece is placed; sequences have no gaps.
    """
    numbered = materialized(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = numbered.filter(F.col("length") >= size)
    done = [whole.withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("bigint")).drop("row")]
    left = numbered.filter(F.col("length") < size)
    count, rounds, before = left.count(), 0, None
    while count:
        shards = -(-count // shard)
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(rounds)), F.lit(shards)))
        packed = materialized(_pack_shards(dealt, size, rounds << 56), "packed").drop("shard")
        rounds += 1
        last = shards == 1 or (before is not None and count > 0.9 * before)
        settled = packed if last else packed.filter(F.col("filled") >= full * size)
        done.append(settled.drop("row", "filled"))
        if last:
            break
        left = packed.filter(F.col("filled") < full * size).drop("sequence_id", "offset", "filled")
        before, count = count, left.count()
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result
