"""Repair of the turn structure of conversations at least cost.

The role initials of a repaired conversation read ``(s?(ua)+)?``. A row may be
kept, given the role user or assistant, or deleted; empty turns may be inserted
anywhere. Blank rows and rows whose role and text came before have to go.

A row is a symbol: the class of its role and its fault. The step of a symbol is
a min-plus matrix between the four states of the pattern. Equal symbols in a
row form a run, which costs are carried over by binary powers of its matrix,
computed once per symbol. The cheapest choices are then unrolled from the front;
of equally cheap ones the letter that sorts first is taken, so the audit is the
least string of all cheapest ones.

A conversation may hold most rows of the table. Identical rows are counted
before any shuffle; the rest is range-partitioned by conversation and position,
so a long conversation lies in several partitions. A part of a conversation is a
matrix as well: a few numbers per partition tell each part its costs behind and
the state it starts in, and parts are unrolled side by side. Only the digest of
such a conversation is sequential by its definition; one task streams it, row by
row.

Defined cases: a null role or text is one space; a null conversation is one like
any other; null turns come first, rows of one turn are ordered by role and text;
a role is known by its first letter (s, u, a; others can only be changed or
deleted); a conversation without rows, or of which nothing stays, has an empty
audit or only deletions and the digest of an empty text; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.joins import attach
from tabloom.llm.common import BLANKS
from tabloom.sources.workspace import checkpointed, materialized

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What the pattern has seen last: nothing, a system, user or assistant turn.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: The state after the one turn (user or assistant) that may come next.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
FAR = 1 << 60
#: Rows of a run that are unrolled at a time.
BLOCK = 1024

Costs = tuple[int, ...]
Runs = tuple[tuple[str, int], ...]


def _inserted() -> tuple[Costs, ...]:
    rows = []
    for state in STATES:
        costs = [FAR] * 4
        for n in range(4):  # a fourth turn would come back to a state passed before
            costs[state] = min(costs[state], n * INSERT)
            state = NEXT[state]
        rows.append(tuple(costs))
    return tuple(rows)


INSERTS = _inserted()


def _through(matrix: tuple[Costs, ...], behind: Costs) -> Costs:
    return tuple(min(a + b for a, b in zip(row, behind)) for row in matrix)


def _times(a: tuple[Costs, ...], b: tuple[Costs, ...]) -> tuple[Costs, ...]:
    return tuple(tuple(min(x + y for x, y in zip(row, column)) for column in zip(*b)) for row in a)


#: The costs at the end: nothing in a state that may end, else the turns that are missing.
FINAL = _through(INSERTS, (0, FAR, FAR, 0))


@lru_cache(None)
def _power(symbol: str, k: int) -> tuple[Costs, ...]:
    """The min-plus matrix of 2**k equal rows, inserted turns before each of them included."""
    if k:
        return _times(_power(symbol, k - 1), _power(symbol, k - 1))
    role, fault = symbol
    row = [[FAR] * 4 for _ in STATES]
    for state in STATES:
        row[state][state] = DELETE
        if fault not in "bd":
            extra = TRUNCATED if fault == "t" else 0
            row[state][NEXT[state]] = min(row[state][NEXT[state]], REROLE + extra)
            if state in KEPT.get(role, {}):
                row[state][KEPT[role][state]] = extra
    return _times(INSERTS, tuple(map(tuple, row)))


def _across(symbol: str, length: int, behind: Costs) -> Costs:
    """The costs before a run, from those behind it."""
    k = 0
    while length:
        if length & 1:
            behind = _through(_power(symbol, k), behind)
        length, k = length >> 1, k + 1
    return behind


def _before(runs: Runs, behind: Costs) -> list[Costs]:
    """The costs before each run, and behind the last one."""
    marks = [behind]
    for symbol, length in reversed(runs):
        marks.append(_across(symbol, length, marks[-1]))
    return marks[::-1]


def matrix(runs: Runs) -> tuple[Costs, ...]:
    """The min-plus matrix of a part of a conversation."""
    units = [tuple(0 if s == t else FAR for s in STATES) for t in STATES]
    return tuple(zip(*(_before(runs, unit)[0] for unit in units)))


@lru_cache(1 << 16)
def _choice(symbol: str, state: int, behind: Costs) -> tuple[str, int, int]:
    """The edits up to the end of one row, their costs and the state after them."""
    role, fault = symbol
    extra = TRUNCATED if fault == "t" else 0
    here = _across(symbol, 1, behind)
    letters, paid = "", 0
    while True:
        left = here[state]
        if DELETE + behind[state] == left:
            return letters + "D", paid + DELETE, state
        if INSERT + here[NEXT[state]] == left:
            letters, paid, state = letters + "I", paid + INSERT, NEXT[state]
            continue
        kept = KEPT.get(role, {}).get(state)
        if kept is not None and extra + behind[kept] == left:
            return letters + "K", paid + extra, kept
        return letters + "R", paid + REROLE + extra, NEXT[state]


def unroll(runs: Runs, state: int = START, behind: Costs = FINAL, last: bool = True) -> tuple[str, int, int]:
    """Audit, cost and last state of a part of a conversation that is entered in ``state``."""
    marks = _before(runs, behind)
    letters, paid = [], 0
    for (symbol, length), after in zip(runs, marks[1:]):
        if symbol[1] in "bd":
            # costs are closed under insertion, so deleting first is as cheap, and D sorts before I
            letters.append("D" * length)
            paid += DELETE * length
            continue
        while length:
            block = min(length, BLOCK)
            length -= block
            costs = [_across(symbol, length, after)]
            for _ in range(block - 1):
                costs.append(_across(symbol, 1, costs[-1]))
            for ahead in reversed(costs):
                low = min(ahead)
                edits, cost, state = _choice(symbol, state, tuple(c - low for c in ahead))
                letters.append(edits)
                paid += cost
    if last:
        missing = FINAL[state] // INSERT
        letters.append("I" * missing)
        paid += FINAL[state]
    return "".join(letters), paid, state


@dataclass(frozen=True)
class Part:
    """What a part of a conversation has to know of the others."""

    state: int = START
    behind: Costs = FINAL
    last: bool = True
    initial: str | None = None
    turn: int | None = None


_short = lru_cache(1 << 16)(unroll)


def _edits(runs: Runs, part: Part) -> tuple[str, int, int]:
    """As :func:`unroll`; short conversations are often alike."""
    return (_short if len(runs) <= 32 else unroll)(runs, part.state, part.behind, part.last)


def _symbols(rows: list[dict]) -> Runs:
    """The runs of equal role and fault symbols; further copies of a row are duplicates, or blank."""
    runs: list[list] = []
    for row in rows:
        again = "b" if row["fault"] == "b" else "d"
        for symbol, n in ((row["initial"] + row["fault"], 1), (row["initial"] + again, row["n"] - 1)):
            if n < 1:
                continue
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += n
            else:
                runs.append([symbol, n])
    return tuple((s, n) for s, n in runs)


def _edited(rows: list[dict], audit: str, state: int) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that stay, in order."""
    at = 0

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, NEXT[state]
            yield NAMES[state], ""

    for row in rows:
        yield from inserted()
        edit = audit[at]
        at += row["n"]  # the other copies are deleted
        if edit == "K":
            state = KEPT[row["initial"]][state]
            yield row["role"], row["text"]
        elif edit == "R":
            state = NEXT[state]
            yield NAMES[state], row["text"]
    yield from inserted()


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, object, list[dict]]]:
    """Partition, conversation and rows (those that exist), of sorted batches."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            found = (row["part"], row["conv"])
            if found != key:
                if key is not None:
                    yield *key, rows
                key, rows = found, []
            if row["n"]:
                rows.append(row)
    if key is not None:
        yield *key, rows


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        columns = list(zip(*held)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def _mapped(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on the groups of each partition; ``conv`` keeps its type."""
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        conv = first.schema.field("conv").type

        def all_batches():
            yield first
            yield from batches

        target = pa.schema([(name, conv if kind == "conv" else types[kind]) for name, kind in fields])
        yield from _batched(work(_groups(all_batches())), target)

    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join(f"{name} {kind if k == 'conv' else k}" for name, k in fields))


def _among(column: str, values: set) -> Column:
    named = F.col(column).isin([v for v in values if v is not None])
    return named | F.col(column).isNull() if None in values else named


def _turns(rows: list[dict]) -> list[int]:
    return [row["turn"] for row in rows if row["turn"] is not None]


def ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column) -> DataFrame:
    """The distinct rows in order, with their number ``n`` and first ``fault``, in fixed partitions.

    A row with no copies only says that its conversation exists.
    """
    there = copies > 0
    space = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    counted = (
        rows.select(
            rows[conv].alias("conv"),
            F.when(there, rows[turn].cast("long")).alias("turn"),
            F.when(there, space(role)).otherwise("").alias("role"),
            F.when(there, space(text)).otherwise("").alias("text"),
            copies.cast("long").alias("n"),
        )
        .groupBy("conv", "turn", "role", "text")
        .agg(F.sum("n").alias("n"))
    )
    named = F.to_json(F.struct(F.col("conv").cast("string"), "role"), {"ignoreNullFields": "false"})
    counted = materialized(counted.withColumn("said", F.sha2(F.concat(named, "text"), 256)), "turns")
    told = (
        counted.filter("n > 0")
        .groupBy("said")
        .agg(F.count(F.lit(1)).alias("told"), F.min(F.struct("turn")).alias("first"))
        .filter("told > 1")
    )
    told = materialized(told.select("said", "told", F.col("first.turn").alias("first")), "told-before")
    met = attach(counted, told, "said", "told", "left")
    dense = F.translate("text", BLANKS, "")
    fault = (
        F.when(dense == "", "b")
        .when(F.col("told").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first")), "d")
        .when(~F.right(dense, F.lit(1)).isin(".", "!", "?"), "t")
        .otherwise("-")
    )
    initial = F.substring("role", 1, 1)
    placed = met.select(
        "conv", "turn", "role", "text", "n", fault.alias("fault"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
    )
    order = ["conv", "turn", "role", "text"]
    ranged = checkpointed(placed.repartitionByRange(*order).sortWithinPartitions(*order))
    return ranged.withColumn("part", F.spark_partition_id())


def _parts(rows: DataFrame) -> dict[tuple, Part]:
    """For conversations in several partitions, what each part has to know: two entries per partition at most."""
    slim = rows.select("part", "conv", "turn", "initial", "fault", "n")

    def ends(groups):
        first = last = None
        for part, conv, _ in groups:
            first = first or (part, conv)
            last = (part, conv)
        if first:
            yield first
        if last != first:
            yield last

    met: dict = {}
    for row in _mapped(slim, ends, "part int, conv conv").collect():
        met.setdefault(row["conv"], []).append(row["part"])
    split = {conv for conv, parts in met.items() if len(parts) > 1}
    if not split:
        return {}
    some = slim.filter(_among("conv", split))

    def measured(groups):
        for part, conv, found in groups:
            turns = _turns(found)
            cells = [c for row in matrix(_symbols(found)) for c in row]
            initial = found[-1]["initial"] if found else None
            yield part, conv, cells, initial, turns[-1] if turns else None

    seen: dict = {}
    for row in _mapped(some, measured, "part int, conv conv, cells array<long>, initial string, turn long").collect():
        seen.setdefault(row["conv"], {})[row["part"]] = row
    known_parts: dict[tuple, Part] = {}
    for conv, of in seen.items():
        behind, order = FINAL, sorted(of)
        for part in reversed(order):
            known_parts[part, conv] = Part(behind=behind, last=part == order[-1])
            cells = of[part]["cells"]
            behind = _through([cells[i : i + 4] for i in range(0, 16, 4)], behind)

    def exits(groups):
        for part, conv, found in groups:
            runs, p = _symbols(found), known_parts[part, conv]
            yield part, conv, [unroll(runs, state, p.behind, False)[2] for state in STATES]

    left = {(r["part"], r["conv"]): r["after"] for r in _mapped(some, exits, "part int, conv conv, after array<long>").collect()}
    for conv, of in seen.items():
        state, initial, turn = START, None, None
        for part in sorted(of):
            p = known_parts[part, conv]
            known_parts[part, conv] = Part(state, p.behind, p.last, initial, turn)
            state = left[part, conv][state]
            initial = of[part]["initial"] or initial
            turn = turn if of[part]["turn"] is None else of[part]["turn"]
    return known_parts


class Repair:
    """The repair of a table of conversations; both results come from the same rows."""

    def __init__(
        self,
        rows: DataFrame,
        conv: str = "conv_id",
        turn: str = "turn",
        role: str = "role",
        text: str = "text",
        copies: Column | None = None,
    ):
        self.conv = conv
        self.rows = ordered(rows, conv, turn, role, text, F.lit(1) if copies is None else copies)
        self.parts = _parts(self.rows)

    def repaired(self, only: set | None = None) -> DataFrame:
        """Conversation, ``part`` and ``place`` (together the order), ``role`` and ``text`` of the repaired rows."""
        parts = self.parts

        def work(groups):
            for part, conv, rows in groups:
                p = parts.get((part, conv), Part())
                audit = _edits(_symbols(rows), p)[0]
                for place, (role, text) in enumerate(_edited(rows, audit, p.state)):
                    yield conv, part, place, role, text

        rows = self.rows
        if only is not None:
            rows = rows.filter(_among("conv", only))
        found = _mapped(rows, work, "conv conv, part int, place long, role string, text string")
        return found.withColumnRenamed("conv", self.conv)

    def report(self) -> DataFrame:
        """One row per conversation: gaps, faults, cost, audit and the digest of the repaired rows."""
        parts = self.parts

        def work(groups):
            for part, conv, rows in groups:
                whole = (part, conv) not in parts
                p = parts.get((part, conv), Part())
                runs = _symbols(rows)
                audit, cost, _ = _edits(runs, p)
                faults = {f: sum(n for symbol, n in runs if symbol[1] == f) for f in "bdt"}
                initials = [p.initial, *(symbol[0] for symbol, _ in runs)]
                illegal = sum(n - 1 for _, n in runs) + sum(
                    a is not None and a + b not in LEGAL for a, b in zip(initials, initials[1:])
                )
                turns = _turns(rows)
                distinct = len(set(turns)) - bool(turns and turns[0] == p.turn)
                digest = None
                if whole:
                    lines = (f"{role}:{text}" for role, text in _edited(rows, audit, p.state))
                    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
                yield (
                    conv, part, whole, faults["b"], faults["d"], faults["t"], illegal, cost, distinct,
                    turns[0] if turns else None, turns[-1] if turns else None, audit, digest,
                )

        counts = ["blank", "duplicate", "truncated", "illegal", "cost", "turns"]
        found = _mapped(
            self.rows,
            work,
            "conv conv, part int, whole boolean, "
            + ", ".join(f"{c} long" for c in counts)
            + ", low long, high long, audit string, digest string",
        )
        whole = found.filter("whole") if parts else found
        if parts:
            found = materialized(found, "repairs")
            pieces = F.array_sort(F.collect_list(F.struct("part", "audit")))
            joined = found.filter("not whole").groupBy("conv").agg(
                *[F.sum(c).alias(c) for c in counts], F.min("low").alias("low"), F.max("high").alias("high"),
                F.array_join(F.transform(pieces, lambda x: x["audit"]), "").alias("audit"),
            )
            joined = joined.withColumnRenamed("conv", "of")
            digests = self._digests({conv for _, conv in parts})
            joined = joined.join(digests, F.col("of").eqNullSafe(F.col("conv"))).drop("of")
            whole = found.filter("whole").unionByName(joined, allowMissingColumns=True)
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
        return whole.select(
            F.col("conv").alias(self.conv), gaps.alias("gaps"), *counts[:-1], "audit", F.col("digest").alias("repaired_sha256")
        )

    def _digests(self, convs: set) -> DataFrame:
        """Digests of conversations that lie in several partitions, streamed in order."""
        rows = self.repaired(convs).withColumnRenamed(self.conv, "conv")
        streamed = rows.repartition("conv").sortWithinPartitions("conv", "part", "place")

        def run(batches):
            key, digest, schema = None, None, None
            for batch in batches:
                schema = pa.schema([batch.schema.field("conv"), ("digest", pa.string())])
                for row in batch.to_pylist():
                    line = f"{row['role']}:{row['text']}".encode()
                    if key is not None and key[0] == row["conv"]:
                        digest.update(b"\n" + line)
                        continue
                    if key is not None:
                        yield from _batched(iter([(key[0], digest.hexdigest())]), schema)
                    key, digest = (row["conv"],), hashlib.sha256(line)
            if key is not None:
                yield from _batched(iter([(key[0], digest.hexdigest())]), schema)

        kind = rows.schema["conv"].dataType.simpleString()
        found = streamed.mapInArrow(run, f"conv {kind}, digest string")
        nothing = hashlib.sha256(b"").hexdigest()
        every = self.rows.sparkSession.createDataFrame([(c,) for c in convs], f"of {kind}")
        met = every.join(found, F.col("of").eqNullSafe(F.col("conv")), "left")
        return met.select(F.col("of").alias("conv"), F.coalesce("digest", F.lit(nothing)).alias("digest"))


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with faults by a checksum of ``conv_id:turn``, and how often each row is there."""
    space = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    hurt = rows.select(
        rows["conv_id"], rows["turn"], F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return hurt, hurt["copies"]
