"""Synthetic rows for small classes, between a row and a near one of its class.

Near rows are found in random-projection trees. A tree cuts each class again and
again, at the mean of a random projection, until a leaf is small. Branches that
are too large for a task are cut by passes over the nodes, one grouped mean for
all trees, of which only the means are kept; nodes then go to their branch once,
where a task goes on cutting. Rows of a leaf are compared with those that become
parents, and the nearest of all trees are kept. Branches without a parent are
neither sent nor compared. Equal vectors of a class are one node, so copies
neither fill a leaf nor crowd out neighbours.

Defined cases: missing values count as the mean when distances are measured; a
synthetic value is missing where its parent's is, and the parent's own where
only the neighbour's is missing; a class with a single vector gets copies of it;
a null label is a class; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, without_nan
from ..functions.joins import attach_any
from ..functions.quantiles import group_key
from ..sources.workspace import delete_tables, materialized
from .profiling import per_column
from .splitting import HASH_RANGE, row_number_hash

#: Trees, nodes of a leaf, and neighbours to choose from.
TREES, LEAF, NEIGHBOURS = 8, 256, 5
#: Projections that are drawn at once, and sets of them; a leaf that is still large after all is dealt by hash.
LEVELS, ROUNDS = 12, 8
#: Nodes, and numbers of their vectors, that a task cuts by itself; branches the driver knows, beyond what size demands.
HELD, HELD_NUMBERS, BRANCHES = 1 << 16, 1 << 22, 1 << 14
#: Bits of a hash that a pass of the search for its rank settles.
DIGIT, DIGITS = 13, 4


def _vectors(array: pa.Array, width: int) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _number(name: str) -> Column:
    return without_nan(col(name).cast("double"), T.DoubleType())


def _standardized(df: DataFrame, features: Sequence[str]) -> list:
    """Features as shares of their standard deviation; missing values and columns without spread are zero."""
    measures = {"mean": ("avg({c})", "double"), "spread": ("stddev_samp({c})", "double")}
    clean = df.select(*[_number(c).alias(c) for c in features])
    found = {r.column_name: r for r in per_column(clean, features, measures).collect()}
    # nine digits, so that the order of summation does not decide
    mean, spread = ({c: float(f"{found[c][m] or other:.9g}") for c in features} for m, other in (("mean", 0.0), ("spread", 1.0)))
    return [F.coalesce((_number(c) - F.lit(mean[c])) / F.lit(spread[c]), F.lit(0.0)) for c in features]


@lru_cache(maxsize=64)
def _directions(width: int, seed: int, tree: int, first_level: int) -> np.ndarray:
    return np.random.default_rng((seed, tree, first_level)).normal(size=(width, LEVELS))


def _projected(x: np.ndarray, seed: int, tree: int, level: int) -> np.ndarray:
    return x @ _directions(x.shape[1], seed, tree, level - level % LEVELS)[:, level % LEVELS]


def _dealt(names: Sequence[str | bytes], parts: int | np.ndarray) -> np.ndarray:
    return np.array([zlib.crc32(n if isinstance(n, bytes) else n.encode()) for n in names], np.int64) % parts


@dataclass
class _Branches:
    """The branches of one class in one tree: where each is cut, or ``low`` -1.

    A branch that no projection has made small is cut by hash, into ``parts`` from ``low`` on.
    """

    depth: list[int] = field(default_factory=lambda: [0])
    mean: list[float] = field(default_factory=lambda: [0.0])
    low: list[int] = field(default_factory=lambda: [-1])
    parts: list[int] = field(default_factory=lambda: [2])
    #: What the last pass has counted: nodes, and nodes whose neighbours are wanted.
    n: list[int] = field(default_factory=lambda: [0])
    wanted: list[int] = field(default_factory=lambda: [0])
    arrays: tuple | None = None

    def cut(self, branch: int, mean: float, parts: int = 2) -> None:
        self.low[branch], self.mean[branch], self.parts[branch] = len(self.depth), mean, parts
        for values, value in ((self.depth, self.depth[branch] + 1), (self.mean, 0.0), (self.low, -1), (self.parts, 2), (self.n, 0), (self.wanted, 0)):
            values.extend([value] * parts)

    def places(self, x: np.ndarray, names: pa.Array, seed: int, tree: int) -> np.ndarray:
        """The branch of each vector, in a task, where branches are cut no more."""
        self.arrays = self.arrays or (np.array(self.low), np.array(self.mean), np.array(self.parts))
        low, mean, parts = self.arrays
        at, level = np.zeros(len(x), np.int64), 0
        while (inner := np.flatnonzero(low[at] >= 0)).size:
            here = at[inner]
            if level < LEVELS * ROUNDS:
                at[inner] = low[here] + (_projected(x[inner], seed, tree, level) > mean[here])
            else:
                at[inner] = low[here] + _dealt(names.take(pa.array(inner)).to_pylist(), parts[here])
            level += 1
        return at


def _counted(nodes: DataFrame, width: int, grown: dict[str, list[_Branches]], seed: int) -> None:
    """One pass: nodes of each branch, the wanted among them, and (as ``mean`` of a branch that is not cut yet) their mean projection."""

    def run(batches):
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds, names = np.array(batch.column(0).to_pylist(), object), batch.column(1)
            vectors, wanted = _vectors(batch.column(2), width), batch.column(3).to_numpy(zero_copy_only=False).astype(float)
            for kind in set(kinds):
                own = np.flatnonzero(kinds == kind)
                x, w = vectors[own], wanted[own]
                ids = names.take(pa.array(own))
                for tree, branches in enumerate(grown[kind]):
                    at, depth = branches.places(x, ids, seed, tree), np.array(branches.depth)
                    p = np.zeros(len(x))
                    for level in np.unique(depth[at]):
                        if level < LEVELS * ROUNDS:
                            there = depth[at] == level
                            p[there] = _projected(x[there], seed, tree, int(level))
                    found = np.stack([np.bincount(at, v, len(depth)) for v in (np.ones(len(x)), w, p)])
                    sums[kind, tree] = sums[kind, tree] + found if (kind, tree) in sums else found
        rows = [(kind, tree, int(b), *map(float, v[:, b])) for (kind, tree), v in sums.items() for b in np.flatnonzero(v[0])]
        columns = list(zip(*rows)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 3))], names=["class", "tree", "branch", "n", "wanted", "total"])

    cells = nodes.filter(F.col("class").isin(list(grown))).select("class", "node", "vector", "wanted").mapInArrow(
        run, "class string, tree int, branch int, n double, wanted double, total double"
    )
    for r in cells.groupBy("class", "tree", "branch").agg(*[F.sum(c).alias(c) for c in ("n", "wanted", "total")]).collect():  # a row per branch
        branches = grown[r["class"]][r.tree]
        branches.n[r.branch], branches.wanted[r.branch] = int(r.n), int(r.wanted)
        # rounded, so that the order of summation does not decide
        branches.mean[r.branch] = round(r.total / r.n, 9)


def _grown(nodes: DataFrame, width: int, trees: int, leaf: int, seed: int) -> dict[str, list[_Branches]]:
    """The branches of classes that are too large for a task, cut until each is not.

    If few neighbours are wanted, cutting goes on while it saves sending nodes.
    Every class has a wanted node.
    """
    held = max(leaf, min(HELD, HELD_NUMBERS // max(width, 1)))
    sizes = nodes.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > held).collect()  # fewer than one in as many nodes as a task holds
    grown = {r["class"]: [_Branches() for _ in range(trees)] for r in large}
    total = sum(r.n for r in large)
    while grown:
        _counted(nodes, width, grown, seed)
        live = [(t, i) for kinds in grown.values() for t in kinds for i, low in enumerate(t.low) if low < 0 and t.wanted[i]]
        saves = sum(t.n[i] for t, i in live) > total / 2 and len(live) <= BRANCHES
        wide = [(t, i) for t, i in live if t.n[i] > (leaf if saves else held) and t.depth[i] <= LEVELS * ROUNDS]
        if not wide:
            break
        for t, i in wide:
            t.cut(i, t.mean[i], 2 if t.depth[i] < LEVELS * ROUNDS else -(-t.n[i] // leaf))
    return grown


def _sent(nodes: DataFrame, width: int, trees: int, grown: dict[str, list[_Branches]], seed: int) -> DataFrame:
    """Nodes with the ``branch`` they go to in each tree, if neighbours are wanted there.

    Branches of the classes in ``grown`` have numbers of their own, and no class; a class that is small is one branch, numbered -1 - tree.
    """
    first, starts = 0, {}
    for kind, kinds in grown.items():
        starts[kind] = []
        for branches in kinds:
            starts[kind].append(first)
            first += len(branches.depth)
    kind_type = nodes.schema["node"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds, names, vectors = np.array(batch.column(0).to_pylist(), object), batch.column(1), _vectors(batch.column(2), width)
            for kind in set(kinds):
                own = np.flatnonzero(kinds == kind)
                ids = names.take(pa.array(own))
                for tree in range(trees):
                    rows, branch = own, np.full(len(own), -1 - tree)
                    if kind in grown:
                        branches = grown[kind][tree]
                        at = branches.places(vectors[own], ids, seed, tree)
                        here = np.array(branches.wanted)[at] > 0
                        rows, branch = own[here], at[here] + starts[kind][tree]
                    if len(rows):
                        part = batch.take(pa.array(rows))
                        name = pa.array(["" if kind in grown else kind] * len(rows), pa.string())
                        yield pa.RecordBatch.from_arrays(
                            [name, pa.array(branch, pa.int32()), *(part.column(i) for i in (1, 2, 3))],
                            names=["class", "branch", "node", "vector", "wanted"],
                        )

    return nodes.select("class", "node", "vector", "wanted").mapInArrow(run, f"class string, branch int, node {kind_type}, vector array<double>, wanted boolean")


def nearest(
    nodes: DataFrame, width: int, k: int = NEIGHBOURS, trees: int = TREES, leaf: int = LEAF, seed: int = 42
) -> DataFrame:
    """``node`` and ``near``: up to k nodes of its class, nearest first.

    ``nodes`` has a row for each different ``vector`` of a ``class``, named
    ``node``; if there is a column ``wanted``, neighbours are looked for where it
    is true, as it is for some node of each class. It is read several times and should be a written table. A neighbour
    is missed if no tree has both in a leaf: tests hold the share that is found
    against brute force. A node alone in its leaves has none.
    """
    if "wanted" not in nodes.columns:
        nodes = nodes.withColumn("wanted", F.lit(True))
    grown = _grown(nodes, width, trees, leaf, seed)
    #: Tree and depth of each branch that was sent.
    known = [(tree, depth) for kinds in grown.values() for tree, branches in enumerate(kinds) for depth in branches.depth]
    name = nodes.schema["node"].dataType.simpleString()

    def leaves(x, own, wanted, tree, depth) -> Iterator[np.ndarray]:
        """Rows of each leaf of a branch in which neighbours are wanted."""
        open_ = [(np.arange(len(own)), depth)]
        while open_:
            rows, level = open_.pop()
            if not wanted[rows].any():
                continue
            if len(rows) <= leaf or level > LEVELS * ROUNDS:
                yield rows
            elif level == LEVELS * ROUNDS:
                part = _dealt(own[rows], -(-len(rows) // leaf))
                open_ += [(rows[part == i], level + 1) for i in np.unique(part)]
            else:
                p = _projected(x[rows], seed, tree, level)
                right = p > round(float(p.mean()), 9)
                open_ += [(rows[right], level + 1), (rows[~right], level + 1)]

    def met(ids, parts, flags, tree, depth):
        own, vectors, wanted = np.array(ids, object), np.concatenate(parts), np.concatenate(flags)
        for rows in leaves(vectors, own, wanted, tree, depth):
            x, asked = vectors[rows], np.flatnonzero(wanted[rows])
            take = min(k, len(rows) - 1)
            if take < 1:
                continue
            for start in range(0, len(asked), 64):
                places = asked[start : start + 64]
                apart = ((x[places, None, :] - x[None, :, :]) ** 2).sum(axis=2)
                here = np.arange(len(places))
                apart[here, places] = np.inf
                best = np.argpartition(apart, take - 1, axis=1)[:, :take]
                found = pa.StructArray.from_arrays(
                    [pa.array(apart[np.repeat(here, take), best.ravel()]), pa.array(own[rows[best.ravel()]], ids_type)], names=["distance", "other"]
                )
                ends = pa.array(np.arange(0, best.size + 1, take, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(own[rows[places]], ids_type), pa.ListArray.from_arrays(ends, found)], names=["node", "near"])

    ids_type = pa.binary() if name == "binary" else pa.string()

    def compare(batches):
        """Batches come sorted by branch; a branch is held at a time."""
        last, ids, parts, flags = None, [], [], []
        of: Callable = lambda key: (-1 - key[1], 0) if key[1] < 0 else known[key[1]]
        for batch in batches:
            kinds, numbers, vectors = batch.column(0).to_pylist(), batch.column(1).to_pylist(), _vectors(batch.column(3), width)
            wanted, keys = batch.column(4).to_numpy(zero_copy_only=False).astype(bool), list(zip(kinds, numbers))
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for begin, end in zip(starts, [*starts[1:], len(keys)]):
                if keys[begin] != last:
                    if ids:
                        yield from met(ids, parts, flags, *of(last))
                    last, ids, parts, flags = keys[begin], [], [], []
                ids.extend(batch.column(2).slice(begin, end - begin).to_pylist())
                parts.append(vectors[begin:end])
                flags.append(wanted[begin:end])
        if ids:
            yield from met(ids, parts, flags, *of(last))

    sent = _sent(nodes, width, trees, grown, seed)
    lists = sent.repartition("class", "branch").sortWithinPartitions("class", "branch", "node").mapInArrow(
        compare, f"node {name}, near array<struct<distance: double, other: {name}>>"
    )
    # at most k for each tree
    found = F.sort_array(F.array_distinct(F.flatten(F.collect_list("near"))))
    return lists.groupBy("node").agg(F.transform(F.slice(found, 1, k), lambda x: x["other"]).alias("near"))


def _limits(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per ``class`` that asks for one, the ``limit``: the hash of the given ``rank`` (from 0) among its rows.

    A pass settles some bits of every class's limit, so neither rows nor their hashes are put in order.
    """
    found = sizes.filter("rank >= 0").select("class", "n", "rank", F.lit(0).cast("bigint").alias("limit"))
    for digit in range(DIGITS):
        shift = DIGIT * (DIGITS - 1 - digit)
        met = attach_any(rows.select("class", "hash"), materialized(found, "class-limits"), "class", "n")
        met = met.filter(F.shiftright("hash", shift + DIGIT) == F.col("limit"))
        next_bits = F.shiftright("hash", shift).alias("bits")
        counts = met.groupBy("class", "n", "rank", next_bits).agg(F.count(F.lit(1)).alias("m"))
        before = Window.partitionBy("class").orderBy("bits").rowsBetween(Window.unboundedPreceding, -1)  # 2 ** DIGIT rows at most
        placed = counts.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
        inside = (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("m"))
        found = placed.filter(inside).select("class", "n", (F.col("rank") - F.col("before")).alias("rank"), F.col("bits").alias("limit"))
    return found.select("class", "limit")


def add_synthetic(
    df: DataFrame, label: str, key: Sequence[str], features: Sequence[str], k: int = NEIGHBOURS, seed: int = 42, **search
) -> DataFrame:
    """All rows, and synthetic ones until every class is as large as the largest.

    Adds ``synthetic``: 0 for a row of the table, else the number of the
    synthetic row of its parent, from which everything but the features, which
    are doubles now, is taken. Every row of a class is a parent equally often;
    those that are one once more have the smallest hashes of key and seed, so
    classes are exactly equal where keys are distinct. Which neighbour, and how
    far towards it, is a hash as well: the result is the same in every run.
    The table is read several times; only rows that become parents are written.
    """
    sizes = materialized(df.groupBy(group_key(col(label)).alias("class")).agg(F.count(F.lit(1)).alias("n")), "class-sizes")
    largest = sizes.agg(F.max("n")).first()[0] or 0
    lacking = F.lit(largest) - F.col("n")
    hashed = row_number_hash(key, seed)
    ranks = sizes.filter(F.col("n") < largest).withColumn("rank", lacking % F.col("n") - 1)
    limits = _limits(df.select(group_key(col(label)).alias("class"), hashed.alias("hash")), ranks)
    limits = materialized(sizes.filter(F.col("n") < largest).join(limits, "class", "left"), "class-limits")

    raw = F.array(*[_number(c) for c in features])
    whole = F.struct(*[col(c) for c in df.columns if c not in features]).alias("whole")
    # rows of the classes that lack some; equal vectors of a class are one node
    held = df.select(
        whole, group_key(col(label)).alias("class"), hashed.alias("hash"), raw.alias("raw"), F.array(*_standardized(df, features)).alias("vector")
    )
    held = held.withColumn("node", F.unhex(F.md5(F.concat_ws("\u0001", "class", F.to_json("raw")))))
    copies = (F.floor(lacking / F.col("n")) + F.coalesce((F.col("hash") <= F.col("limit")).cast("bigint"), F.lit(0))).alias("copies")
    marked = attach_any(held, limits, "class", "n").select("whole", "class", "hash", "raw", "vector", "node", copies)

    first = [F.first(c).alias(c) for c in ("class", "vector", "raw")]
    classes = marked.groupBy("node").agg(*first, F.count(F.lit(1)).alias("rows"), F.max(F.col("copies") > 0).alias("wanted"))
    classes = materialized(classes, "class-vectors")
    near = nearest(classes, len(features), k, seed=seed, **search)
    near = near.withColumnRenamed("near", "others")
    known = materialized(classes.filter("wanted").select("node", "rows").join(near, "node", "left"), "near-nodes")

    marked = materialized(marked.filter("copies > 0").select("whole", "hash", "raw", "node", "copies"), "parents")
    parents = attach_any(marked, known, "node", "rows")
    born = parents.withColumn("synthetic", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    drawn = lambda what: F.pmod(F.xxhash64(F.lit(f"{what}{seed}"), "hash", "synthetic"), F.lit(HASH_RANGE))
    number = F.size(F.coalesce("others", F.array().cast(known.schema["others"].dataType)))
    born = born.withColumn("other", F.when(number > 0, F.element_at("others", (drawn("which") % number + 1).cast("int"))))
    born = materialized(born.select("whole", "raw", "synthetic", "other", (drawn("gap") / F.lit(float(HASH_RANGE))).alias("gap")), "drawn")
    delete_tables(marked, known)
    wanted = materialized(born.filter("other IS NOT NULL").groupBy("other").agg(F.count(F.lit(1)).alias("drawn")), "drawn-nodes")
    targets = wanted.join(classes.select(F.col("node").alias("other"), F.col("raw").alias("target")), "other")
    targets = materialized(targets, "targets")
    delete_tables(classes, wanted)
    met = attach_any(born, targets, "other", "drawn", "left")
    between = F.zip_with("raw", F.coalesce("target", "raw"), lambda x, y: x + F.col("gap") * (F.coalesce(y, x) - x))
    made = met.select("whole", between.alias("raw"), "synthetic")
    place = {c: i for i, c in enumerate(features)}
    out = [F.col("raw")[place[c]].alias(c) if c in place else F.col("whole").getField(c).alias(c) for c in df.columns]
    rows = df.select(*[_number(c).alias(c) if c in place else col(c) for c in df.columns], F.lit(0).alias("synthetic"))
    return rows.unionByName(made.select(*out, "synthetic"))
