"""Near-duplicates by SimHash, compared exactly in tiles.

Tasks fingerprint whole texts. Equal fingerprints are one node, so copies are
never paired. Nodes are put into cells by the population counts of the parts of
their first word: two fingerprints that differ in r bits have counts that differ
by r at most, so only cells within the radius meet, and all other tile pairs are
skipped. A large cell is several tiles. Each task holds one tile, streams the
nodes that visit it, and compares all of them with numpy's exclusive-or and bit
counts. Of a clump of nodes that are all linked it emits a spanning forest, not
the pairs; components of the forests are those of all links.

A link of ``keep_one`` is more than a small distance. Sets of shingles that are
similar share one of their rarest shingles, so only texts in such a block meet;
in each block fingerprints are compared in tiles as above. Components of near
fingerprints only say which texts may be alike: inside each of them the sets of
shingles are compared, again in tiles, and a link counts if their similarity is
high enough.

There are at most 83,521 cells (17 counts for each of four parts), and what the
driver gets is a count for each.

Defined cases: a null or empty text, or one without words, has fingerprint zero;
fewer words than a shingle are one shingle; a null id is never the smallest of
its component; repeated rows share fingerprint and component; an empty table
gives an empty result; other columns pass through ``keep_one`` untouched.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.joins import attach, attach_any
from tabloom.llm.common import texts
from tabloom.llm.components import components
from tabloom.sources.workspace import materialized

#: Nodes of a tile.
TILE = 8192
#: Differences that are counted at once; they stay in the processor's cache.
CHUNK = 1 << 18
#: Nodes and bytes of shingle sets of a tile in which sets are compared.
SET_TILE, SET_BYTES = 1024, 1 << 22
#: Sets of shingles up to this size are found by the shingles they share, as few bits say little of small sets.
SHORT = 32
#: Counters of shingles in a task: a fixed size, whatever the table.
BUCKETS = 1 << 20
SEED = 42


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of each run of words, A-Z lower-cased, joined by single spaces."""
    import xxhash

    words = text.encode().lower().split()  # on bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.empty(0, ">u8")
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.frombuffer(xxhash.xxh64_digest(joined, SEED), ">u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())]), ">u8")


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """The different shingles of a text, by their hashes, in order."""
    return np.unique(shingle_hashes(text, shingle).astype("<u8"))


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sets, in order, have a similarity (Jaccard) of ``least`` or more."""
    if len(a) == 0 or len(b) == 0:
        return len(a) == len(b)
    if min(len(a), len(b)) / max(len(a), len(b)) < least:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) >= least


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further independent hash words of the same shingles (the finaliser of splitmix64)."""
    z = hashes.astype("<u8") + np.uint64(word * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))).astype(">u8")


def fingerprint(text: str, shingle: int, words: int = 1, distinct: bool = False) -> bytes:
    """A bit is one if it is set in over half of the hashes; most significant byte first, word by word.

    A repeated shingle counts each time, or once if ``distinct``.
    """
    hashes = shingle_hashes(text, shingle)
    return majority_bits(np.unique(hashes) if distinct else hashes, words)


def majority_bits(hashes: np.ndarray, words: int) -> bytes:
    out = []
    for word in range(words):
        own = hashes.astype(">u8") if word == 0 else _mixed(hashes, word)
        ones = np.zeros(64, np.int64)
        for start in range(0, len(own), 4096):
            bits = np.unpackbits(np.ascontiguousarray(own[start : start + 4096]).view(np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * ones > len(own)).tobytes())
    return b"".join(out)


def first_shingles(own: np.ndarray, least: float) -> np.ndarray:
    """Of a small set its lowest hashes, so many that two similar sets share one of them; none of other sets.

    Two sets are both small, or neither needs it: one up to SHORT may be similar
    to one up to SHORT / least.
    """
    if not 0 < len(own) <= SHORT / least:
        return own[:0]
    return own[: len(own) - math.ceil(least * len(own) - 1e-9) + 1]


def common_shingles(rows: DataFrame, shingle: int, times: float = 2.0, more: int = 8) -> np.ndarray:
    """About how many texts have the shingles of each bucket, if that is many; else 0.

    A task counts its texts' shingles by bucket and tells of those with over
    ``times`` the average and ``more``. What is found only orders shingles, so an
    estimate costs time at worst and never a link. The driver gets BUCKETS
    numbers at most.
    """

    def run(batches):
        counts, waiting, size = np.zeros(BUCKETS, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0):
                waiting.append(shingle_set(text.as_py(), shingle))
                size += len(waiting[-1])
                if size > BUCKETS:
                    counts += np.bincount(buckets(np.concatenate(waiting)), minlength=BUCKETS)
                    waiting, size = [], 0
        if waiting:
            counts += np.bincount(buckets(np.concatenate(waiting)), minlength=BUCKETS)
        places = np.flatnonzero(counts > times * counts.sum() / BUCKETS + more)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(counts[places])], ["bucket", "n"])

    counted = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table, weights = counted.toArrow(), np.zeros(BUCKETS, np.int64)
    weights[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return weights


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def rarest_shingles(own: np.ndarray, least: float, weights: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set, so many that two similar sets share one of them.

    All sets order shingles alike: by weight, then by hash.
    """
    if not len(own):
        return own
    ordered = own[np.lexsort((own, weights[buckets(own)]))]
    return ordered[: len(own) - math.ceil(least * len(own) - 1e-9) + 1]


def set_prints(rows: DataFrame, shingle: int, words: int, least: float, weights) -> DataFrame:
    """Adds ``fingerprint``, ``size`` and ``rarest`` in place of ``text``.

    The fingerprint is that of the set of shingles, and 128 bits that equal sets
    have. ``weights`` is a broadcast of :func:`common_shingles`.
    """
    names = [c for c in rows.columns if c != "text"]
    made = [T.StructField("fingerprint", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("rarest", T.BinaryType())]
    schema = T.StructType([rows.schema[c] for c in names] + made)

    def run(batches):
        for batch in batches:
            prints, sizes, rarest = [], [], []
            for x in batch.column(len(names)):
                own = shingle_set(x.as_py(), shingle)
                prints.append(majority_bits(own, words) + hashlib.md5(own.tobytes()).digest())
                sizes.append(len(own))
                rarest.append(rarest_shingles(own, least, weights.value).tobytes())
            columns = [batch.column(i) for i in range(len(names))]
            made = [pa.array(prints, pa.binary()), pa.array(sizes, pa.int64()), pa.array(rarest, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *made], schema.names)

    return rows.select(*names, "text").mapInArrow(run, schema)


def fingerprints(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """Adds ``fingerprint`` in place of ``text``; all other columns pass through."""
    names = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("fingerprint", T.BinaryType())])

    def run(batches):
        for batch in batches:
            found = [fingerprint(x.as_py(), shingle, words) for x in batch.column(len(names))]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], schema.names)

    return docs.select(*names, "text").mapInArrow(run, schema)


def _words_of(column: pa.Array, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, words)


def cells_of(first: np.ndarray, parts: int) -> np.ndarray:
    """The population counts of the parts of a word, as one number."""
    width = 64 // parts
    mask = np.uint64((1 << width) - 1)
    cell = np.zeros(len(first), np.int64)
    for k in range(parts):
        cell = cell * (width + 1) + np.bitwise_count((first >> np.uint64(k * width)) & mask)
    return cell


@lru_cache(maxsize=4)
def _steps(radius: int, parts: int) -> list[tuple[int, ...]]:
    """Differences of population counts that the radius allows, one of each pair of opposites."""
    span = range(-min(radius, 64 // parts), min(radius, 64 // parts) + 1)
    return [s for s in itertools.product(span, repeat=parts) if sum(map(abs, s)) <= radius and s > (0,) * parts]


def _neighbours(cell: int, radius: int, parts: int) -> list[int]:
    base, counts = 64 // parts + 1, []
    for _ in range(parts):
        cell, count = divmod(cell, base)
        counts.append(count)
    counts.reverse()
    found = []
    for step in _steps(radius, parts):
        near = [c + s for c, s in zip(counts, step)]
        if all(0 <= c < base for c in near):
            code = 0
            for c in near:
                code = code * base + c
            found.append(code)
    return found


class Forest:
    """Links among the nodes of a tile and its visitors, less those that are already implied."""

    def __init__(self, nodes: np.ndarray):
        self.nodes, self.parent = nodes, np.arange(len(nodes))
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links between tile places a and b."""
        la, lb = self.parent[a], self.parent[b]
        apart = la != lb
        if not apart.any():
            return
        pairs = np.unique(np.stack([np.minimum(la[apart], lb[apart]), np.maximum(la[apart], lb[apart])]), axis=1)
        kept = []
        for x, y in pairs.T.tolist():
            x, y = self._root(x), self._root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                kept.append((x, y))
        if kept:
            places = np.array(kept)
            self.links.append((self.nodes[places[:, 0]], self.nodes[places[:, 1]]))
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up

    def visit(self, visitors: np.ndarray, v: np.ndarray, h: np.ndarray) -> None:
        """Visitors linked to tile places: one link each, and what they show to be connected."""
        seen, first = np.unique(v, return_index=True)
        self.links.append((visitors[seen], self.nodes[h[first]]))
        self.join(h, h[first][np.searchsorted(seen, v)])


def _near(tile: np.ndarray, rows: np.ndarray, radius: int, total: int):
    """Pairs (row, place in the tile) within the radius in the first word and within the total in all."""
    step = max(1, CHUNK // max(1, len(tile)))
    first = np.ascontiguousarray(tile[:, 0])
    for start in range(0, len(rows), step):
        part = rows[start : start + step]
        v, h = np.nonzero(np.bitwise_count(part[:, :1] ^ first[None, :]) <= radius)
        if rows.shape[1] > 1 and len(v):
            keep = []
            for i in range(0, len(v), CHUNK // rows.shape[1]):
                j = slice(i, i + CHUNK // rows.shape[1])
                keep.append(np.bitwise_count(part[v[j]] ^ tile[h[j]]).sum(axis=1, dtype=np.int64) <= total)
            keep = np.concatenate(keep)
            v, h = v[keep], h[keep]
        if len(v):
            yield v + start, h


def links(nodes: DataFrame, words: int, radius: int, total: int, parts: int, tile: int = TILE) -> DataFrame:
    """A spanning forest (a, b) of all links between nodes (``node``, ``fingerprint``)."""

    def cell(batches):
        for batch in batches:
            got = cells_of(_words_of(batch.column(0), words)[:, 0], parts)
            yield pa.RecordBatch.from_arrays([pa.array(got)], ["cell"])

    counted = nodes.select("fingerprint").mapInArrow(cell, "cell long").groupBy("cell").count()
    # tiles of each cell; the number of cells is bounded by their definition
    tiles = {row["cell"]: -(-row["count"] // tile) for row in counted.collect()}

    def deal(batches):
        targets: dict = {}
        for batch in batches:
            node = batch.column(0).to_numpy()
            own = cells_of(_words_of(batch.column(1), words)[:, 0], parts)
            rows, keys, roles = [], [], []

            def send(places, key, role):
                rows.append(places)
                keys.append(np.broadcast_to(np.asarray(key, np.int64), len(places)))
                roles.append(np.full(len(places), role, np.int8))

            order = np.argsort(own, kind="stable")
            starts = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]]) if len(order) else []
            for begin, end in zip(starts, [*starts[1:], len(order)]):
                places = order[begin:end]
                c = int(own[places[0]])
                n = tiles[c]
                # a hash of the node, so that tiles of a cell are alike in size
                sub = ((node[places].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % n
                send(places, c << 32 | sub, 0)
                for ahead in range(1, n // 2 + 1):  # each two tiles of a cell meet once
                    there = (sub + ahead) % n
                    once = slice(None) if 2 * ahead != n else np.flatnonzero(sub < there)
                    send(places[once], c << 32 | there[once], 1)
                if c not in targets:
                    targets[c] = [(x, tiles[x]) for x in _neighbours(c, radius, parts) if x in tiles]
                for x, count in targets[c]:
                    for k in range(count):
                        send(places, x << 32 | k, 1)
            for i in range(0, len(rows), 64):
                take = np.concatenate(rows[i : i + 64])
                chosen = pa.array(take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys[i : i + 64])), pa.array(np.concatenate(roles[i : i + 64])),
                     batch.column(0).take(chosen), batch.column(1).take(chosen)], ["key", "role", "node", "fingerprint"],
                )

    dealt = nodes.select("node", "fingerprint").mapInArrow(deal, "key long, role byte, node long, fingerprint binary")

    def compare(batches):
        key, homes, home_nodes, state = None, [], [], None

        def out(forest):
            a = np.concatenate([x for x, _ in forest.links]) if forest.links else np.empty(0, np.int64)
            b = np.concatenate([x for _, x in forest.links]) if forest.links else np.empty(0, np.int64)
            forest.links = []
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        def ready():
            matrix = np.concatenate(homes)
            forest = Forest(np.concatenate(home_nodes))
            for v, h in _near(matrix, matrix, radius, total):
                below = v < h
                if below.any():
                    forest.join(v[below], h[below])
            return matrix, forest

        for batch in batches:
            keys, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ids, prints = batch.column(2).to_numpy(), _words_of(batch.column(3), words)
            change = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (roles[1:] != roles[:-1])]) if len(keys) else []
            for begin, end in zip(change, [*change[1:], len(keys)]):
                if keys[begin] != key:
                    if key is not None:
                        yield out((state or ready())[1])
                    key, homes, home_nodes, state = keys[begin], [], [], None
                if roles[begin] == 0:
                    homes.append(prints[begin:end])
                    home_nodes.append(ids[begin:end])
                    continue
                if state is None:
                    state = ready()
                for v, h in _near(state[0], prints[begin:end], radius, total):
                    state[1].visit(ids[begin:end], v, h)
                yield out(state[1])
        if key is not None:
            yield out((state or ready())[1])

    return dealt.repartition("key").sortWithinPartitions("key", "role").mapInArrow(compare, "a long, b long")


def _tied(own: np.ndarray, places: np.ndarray, sets: list[np.ndarray], label: np.ndarray, least: float) -> list[int]:
    """Of the candidate places with sets similar to a set, the first one of each label."""
    found = []
    while len(places):
        place = places[0]
        if similar(own, sets[place], least):
            found.append(place)
            places = places[label[places] != label[place]]
        else:
            places = places[1:]
    return found


class SetTile:
    """Links of a tile whose sets are similar, less those that are already implied."""

    def __init__(self, nodes: list[int], prints: np.ndarray, sets: list[np.ndarray], total: int, least: float):
        self.nodes, self.prints, self.sets = nodes, prints, sets
        self.total, self.least = total, least
        self.sizes = np.array([len(x) for x in sets])
        self.label = np.arange(len(nodes))
        self.links: list[tuple[int, int]] = []
        self.sharing: dict[int, list[int]] = defaultdict(list)
        for place in range(len(nodes)):
            self.visit(nodes[place], prints[place], sets[place], place)
            for x in first_shingles(sets[place], least).tolist():
                self.sharing[x].append(place)

    def _candidates(self, own_print: np.ndarray, own: np.ndarray, end: int) -> np.ndarray:
        """Places before ``end``, nearest first."""
        apart = np.bitwise_count(self.prints[:end] ^ own_print).sum(axis=1, dtype=np.int64)
        near = apart <= self.total
        for x in first_shingles(own, self.least).tolist():
            if x in self.sharing:
                near[self.sharing[x]] = True
        places = np.flatnonzero(near)
        places = places[np.argsort(apart[places], kind="stable")]
        sizes = self.sizes[places]
        return places[np.minimum(sizes, len(own)) >= self.least * np.maximum(sizes, len(own)) - 1e-9]

    def visit(self, node: int, own_print: np.ndarray, own: np.ndarray, place: int | None = None) -> None:
        """A visitor, or a place of the tile that meets those before it."""
        candidates = self._candidates(own_print, own, len(self.nodes) if place is None else place)
        found = _tied(own, candidates, self.sets, self.label, self.least)
        if found:
            self.links.extend((node, self.nodes[x]) for x in found)
            alike = found if place is None else [*found, place]
            self.label[np.isin(self.label, self.label[alike])] = self.label[alike[0]]


def similar_links(sets: DataFrame, words: int, total: int, least: float, tile: int = SET_TILE) -> DataFrame:
    """A spanning forest (a, b) of the links inside each ``root`` whose sets of shingles are similar.

    ``sets`` is a written table of ``node``, ``root``, ``fingerprint`` and
    ``shingles``. Two nodes of a root meet in one tile, whatever its size.
    """
    sizes = sets.groupBy("root").agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.octet_length("shingles")).alias("bytes"))
    tiles = F.ceil(F.greatest(F.col("nodes") / tile, F.col("bytes") / SET_BYTES, F.lit(1.0))).cast("long")
    sizes = materialized(sizes.select("root", "nodes", tiles.alias("n")), "root-sizes")
    own = attach(sets, sizes, "root", "nodes").withColumn("sub", F.pmod(F.xxhash64("node"), "n"))
    ahead = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("n div 2"))).alias("ahead")
    dealt = own.select("*", ahead).withColumn("tile", (F.col("sub") + F.col("ahead")) % F.col("n"))
    dealt = dealt.filter("ahead = 0 OR 2 * ahead <> n OR sub < tile")  # each two tiles of a root meet once
    dealt = dealt.selectExpr("root", "tile", "ahead > 0 AS visitor", "node", "fingerprint", "shingles")

    def run(batches):
        key, homes, state = None, [], None

        def ready():
            nodes, prints, sets = zip(*homes)
            return SetTile(list(nodes), np.stack(prints), list(sets), total, least)

        def out(state):
            places = np.array(state.links, np.int64).reshape(-1, 2)
            state.links = []
            return pa.RecordBatch.from_arrays([pa.array(places[:, 0]), pa.array(places[:, 1])], ["a", "b"])

        for batch in batches:
            prints = _words_of(batch.column(4), words)
            for i, (root, tile, visitor, node) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)))):
                if (root, tile) != key:
                    if homes:
                        yield out(state or ready())
                    key, homes, state = (root, tile), [], None
                own = np.frombuffer(batch.column(5)[i].as_py(), "<u8")
                if not visitor:
                    homes.append((node, prints[i], own))
                elif homes:  # a tile may have got no node
                    state = state or ready()
                    state.visit(node, prints[i], own)
        if homes:
            yield out(state or ready())

    ordered = dealt.repartition("root", "tile").sortWithinPartitions("root", "tile", "visitor")
    return ordered.mapInArrow(run, "a long, b long")


def _shingle_sets(rows: DataFrame, shingle: int) -> DataFrame:
    """``shingles`` in place of ``text``, which is the last column."""
    names = rows.columns[:-1]
    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField("shingles", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [shingle_set(x.as_py(), shingle).tobytes() for x in part.column(len(names))]
                columns = [part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


def shared_shingles(nodes: DataFrame, weights) -> DataFrame:
    """``shingle`` and ``node`` of the rarest shingles that may stand in several nodes.

    Rare ones meet by hash, and those of one node go. Of common ones, any number
    of nodes may have one: they need no such look, and are not shuffled.
    """

    def emit(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            shingles = np.frombuffer(b"".join(raw), "<u8")
            owners = np.repeat(batch.column(0).to_numpy(), [len(x) // 8 for x in raw])
            common = weights.value[buckets(shingles)] > 0
            for i in range(0, len(owners), 1 << 16):
                part = slice(i, i + (1 << 16))
                columns = [pa.array(shingles[part].view("<i8")), pa.array(owners[part]), pa.array(common[part])]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "node", "common"])

    def several(batches):
        """Rows of a shingle that is not the only one of its kind; equal ones follow each other."""
        last = None  # of the batch before: shingle, node, and whether it has been passed on
        for batch in batches:
            if not batch.num_rows:
                continue
            shingle, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            like_before = np.r_[last is not None and shingle[0] == last[0], shingle[1:] == shingle[:-1]]
            like_after = np.r_[shingle[1:] == shingle[:-1], False]
            if like_before[0] and not last[2]:
                yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]])], ["shingle", "node"])
            kept = like_before | like_after
            last = shingle[-1], node[-1], kept[-1]
            yield pa.RecordBatch.from_arrays([pa.array(shingle[kept]), pa.array(node[kept])], ["shingle", "node"])

    emitted = nodes.select("node", "rarest").mapInArrow(emit, "shingle long, node long, common boolean")
    rare = emitted.filter("NOT common").select("shingle", "node").repartition("shingle").sortWithinPartitions("shingle")
    return rare.mapInArrow(several, "shingle long, node long").unionByName(emitted.filter("common").select("shingle", "node"))


class Block:
    """A tile of a block: nodes with prints and sizes of sets, and the links among them and to visitors."""

    def __init__(self, parts, words: int, radius: int, total: int, least: float):
        self.prints, self.sizes = np.concatenate([p for _, p, _ in parts]), np.concatenate([s for _, _, s in parts])
        self.limits = radius, total, least
        self.forest = Forest(np.concatenate([n for n, _, _ in parts]))
        for v, h in self._alike(self.prints, self.sizes):
            below = v < h
            if below.any():
                self.forest.join(v[below], h[below])

    def _alike(self, prints: np.ndarray, sizes: np.ndarray):
        radius, total, least = self.limits
        step = max(1, CHUNK // max(1, len(self.prints)))
        short = self.sizes <= SHORT / least
        for start in range(0, len(prints), step):
            part = slice(start, start + step)
            near = np.bitwise_count(prints[part, :1] ^ self.prints[None, :, 0]) <= radius
            small = sizes[part] <= SHORT / least
            if short.any() and small.any():
                near |= small[:, None] & short[None, :]
            v, h = np.nonzero(near)
            v += start
            for i in range(0, len(v), CHUNK // prints.shape[1]):
                a, b = v[i : i + CHUNK // prints.shape[1]], h[i : i + CHUNK // prints.shape[1]]
                kept = alike(prints[a], sizes[a], self.prints[b], self.sizes[b], total, least)
                if kept.any():
                    yield a[kept], b[kept]

    def visit(self, nodes: np.ndarray, prints: np.ndarray, sizes: np.ndarray) -> None:
        for v, h in self._alike(prints, sizes):
            self.forest.visit(nodes, v, h)


def alike(prints: np.ndarray, sizes: np.ndarray, others: np.ndarray, other_sizes: np.ndarray, total: int, least: float) -> np.ndarray:
    """Whether two sets may be similar, row by row: by their sizes, and by their prints if they are not both small."""
    low, high = np.minimum(sizes, other_sizes), np.maximum(sizes, other_sizes)
    near = np.bitwise_count(prints ^ others).sum(axis=1, dtype=np.int64) <= total
    return (near | (high <= SHORT / least)) & (low >= least * high - 1e-9)


def block_links(nodes: DataFrame, weights, words: int, radius: int, total: int, least: float, tile: int = TILE) -> DataFrame:
    """A spanning forest (a, b) of the links between nodes that share one of their rarest shingles.

    ``nodes`` is a written table of ``node``, ``fingerprint``, ``size`` and
    ``rarest``. Blocks of the same nodes are compared once. A block of more than
    a tile is cut by size of set as well, where only neighbouring sizes meet.
    """
    shared = materialized(shared_shingles(nodes, weights), "shared-shingles")
    blocks = shared.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    blocks = blocks.filter("n > 1").groupBy("n", "one", "two").agg(F.min("shingle").alias("shingle")).select("shingle", "n")
    members = attach(shared, materialized(blocks, "blocks"), "shingle", "n")
    tiles = F.ceil(F.col("n") / tile).cast("long")
    members = materialized(members.select("shingle", "node", tiles.alias("tiles")), "block-members")
    prints = nodes.select("node", F.substring("fingerprint", 1, 8 * words).alias("fingerprint"), "size")
    # similar sets are in one class of sizes or in neighbouring ones
    classes = F.when(F.col("tiles") > 1, F.floor(F.log("size") / F.lit(-math.log(least)))).otherwise(F.lit(0).cast("long"))
    whole = members.join(prints, "node").withColumn("class", classes)
    sub = F.pmod(F.xxhash64("node", "shingle"), "tiles")
    meets = F.expr(
        "concat(transform(sequence(0L, tiles div 2), x -> struct(class AS class, x AS ahead)),"
        " if(tiles > 1, transform(sequence(0L, tiles - 1), x -> struct(class + 1 AS class, x AS ahead)), array()))"
    )
    dealt = whole.withColumn("sub", sub).withColumn("meets", F.explode(meets))
    ahead, home = F.col("meets.ahead"), F.col("meets.class") == F.col("class")
    dealt = dealt.withColumn("tile", (F.col("sub") + ahead) % F.col("tiles"))
    once = ~home | (ahead == 0) | (2 * ahead != F.col("tiles")) | (F.col("sub") < F.col("tile"))  # each two tiles meet once
    visitor = ~(home & (ahead == 0))
    dealt = dealt.filter(once).select("shingle", F.col("meets.class").alias("class"), "tile", visitor.alias("visitor"), "node", "fingerprint", "size")

    def run(batches):
        key, homes, state = None, [], None

        def table(pairs):
            a = np.concatenate([x for x, _ in pairs]) if pairs else np.empty(0, np.int64)
            b = np.concatenate([x for _, x in pairs]) if pairs else np.empty(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        def finished():
            block = state or (Block(homes, words, radius, total, least) if sum(len(n) for n, _, _ in homes) > 1 else None)
            return block.forest.links if block else []

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            visits = batch.column(3).to_numpy(zero_copy_only=False)
            ids, prints, sizes = batch.column(4).to_numpy(), _words_of(batch.column(5), words), batch.column(6).to_numpy()
            new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
            cuts = np.r_[np.flatnonzero(new | np.r_[True, visits[1:] != visits[:-1]]), len(keys)]
            begins, ends, pairs = cuts[:-1], cuts[1:], []
            # most blocks are two nodes; those that lie inside the batch are compared together
            two = (ends - begins == 2) & ~visits[begins] & new[begins] & np.r_[new[begins[1:]], False]
            two[0] = False
            first = begins[two]
            if len(first):
                kept = alike(prints[first], sizes[first], prints[first + 1], sizes[first + 1], total, least)
                pairs.append((ids[first[kept]], ids[first[kept] + 1]))
            for begin, end in zip(begins[~two].tolist(), ends[~two].tolist()):
                if tuple(keys[begin]) != key:
                    pairs += finished()
                    key, homes, state = tuple(keys[begin]), [], None
                rows = ids[begin:end], prints[begin:end], sizes[begin:end]
                if not visits[begin]:
                    homes.append(rows)
                elif homes:  # a tile may have got no node
                    state = state or Block(homes, words, radius, total, least)
                    state.visit(*rows)
                    pairs += state.forest.links
                    state.forest.links = []
            yield table(pairs)
        yield table(finished())

    order = ["shingle", "class", "tile"]
    return dealt.repartition(*order).sortWithinPartitions(*order, "visitor").mapInArrow(run, "a long, b long")


def grouped(rows: DataFrame, first: Column, forest_of, verified=None) -> DataFrame:
    """Rows with a ``fingerprint``, and ``lowest``: the smallest ``first`` in their component.

    Rows are one node if their fingerprints are equal; other columns but ids are
    then equal, too. ``forest_of`` gives links of the nodes. With ``verified``,
    they come from what it returns for the nodes and their components.
    """
    more = [c for c in ("size", "rarest") if c in rows.columns]
    classes = rows.groupBy("fingerprint").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in more]
    )
    rows = rows.drop(*more)
    nodes = materialized(classes.withColumn("node", F.monotonically_increasing_id()), "fingerprint-classes")
    found = materialized(components(materialized(forest_of(nodes), "link-forest")), "components")
    if verified is not None:
        found = materialized(components(materialized(verified(nodes, found), "verified-forest")), "components")
    rooted = nodes.drop(*more).join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialized(rooted, "rooted-classes")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"), F.count(F.lit(1)).alias("classes"))
    lowest = materialized(lowest, "component-heads")
    known = attach(rooted.select("root", "fingerprint", "copies"), lowest, "root", "classes").drop("root", "classes")
    return attach(rows, materialized(known, "fingerprint-heads"), "fingerprint", "copies").drop("copies")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, parts: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (binary, 64 bits) and ``component_id``.

    Documents whose fingerprints differ in ``radius`` bits or fewer are linked;
    ``component_id`` is the smallest id reachable.
    """
    rows = materialized(fingerprints(texts(docs, id_col, text_col), shingle, 1), "fingerprints")
    first = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id"))
    found = grouped(rows, first, lambda nodes: links(nodes, 1, radius, radius, parts))
    return found.select("doc_id", "fingerprint", F.col("lowest.doc_id").alias("component_id"))


def keep_one(
    docs: DataFrame,
    shingle: int = 5,
    words: int = 16,
    radius: int = 24,
    total: int = 200,
    least: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: the smallest id of each group, with all columns.

    Of a group without any id the row with the smallest identity stays.

    Texts are linked if their sets of five-word shingles have a similarity
    (Jaccard) of ``least`` or more, compared set by set. Which sets to compare is
    found in two steps. Sets that are similar share one of their rarest shingles,
    which leaves out none. Among those, fingerprints of 1,024 bits are compared:
    at 0.8 their expected distance is 155, with a standard deviation of 11.5, so
    200 leaves out 1 pair in 20,000; in tiles, the first word may differ in 24 of
    64 bits, which leaves out 1 in a million. Sets of at most 32 shingles miss
    none: those that share a rare shingle are compared whatever their bits.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    identity = F.unhex(F.md5(F.concat(F.coalesce(docs[id_col].cast("string"), F.lit("null")), F.lit("\n"), text)))
    source = docs.select(docs[id_col].alias("doc_id"), identity.alias("identity"), text.alias("text"))
    weights = docs.sparkSession.sparkContext.broadcast(common_shingles(source, shingle))
    rows = materialized(set_prints(source, shingle, words, least, weights), "fingerprints")

    def verified(nodes, found):
        wanted = nodes.join(found, "node").select(
            "node", "root", F.substring("fingerprint", 1, 8 * words).alias("fingerprint"), "first.identity", "copies"
        )
        wanted = materialized(wanted, "candidates")
        read = attach_any(source.select("identity", "text"), wanted, "identity", "copies")
        read = read.groupBy("node", "root", "fingerprint").agg(F.first("text").alias("text"))  # repeated rows are alike
        return similar_links(materialized(_shingle_sets(read, shingle), "shingle-sets"), words, total, least)

    first = F.struct(F.col("doc_id").isNull(), "doc_id", "identity")  # ids first, then rows without one
    found = grouped(rows, first, lambda nodes: block_links(nodes, weights, words, radius, total, least), verified)
    kept = found.filter(F.col("lowest.identity") == F.col("identity")).select("identity").distinct()
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    tie = F.xxhash64(F.to_json(F.struct(*[docs[c] for c in others]))) if others else F.lit(0)
    whole = docs.select(identity.alias("identity"), F.struct(*[docs[c] for c in docs.columns]).alias("whole"), tie.alias("tie"))
    whole = whole.groupBy("identity").agg(F.max_by("whole", "tie").alias("whole"))
    return whole.join(kept, "identity").select("whole.*")
