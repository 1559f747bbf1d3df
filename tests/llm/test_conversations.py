import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tabloom.llm import conversation_repair as cr
from tabloom.llm.registered import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, audit string, part int"
BLANKS = " \t\n\x0b\f\r"


def fault(role, text, seen):
    dense = text.rstrip(BLANKS)
    if not dense:
        return "b"
    if (role, text) in seen:
        return "d"
    return "-" if dense[-1] in ".!?" else "t"


def cheapest(symbols):
    """(cost, audit): all suffixes of all states, their audits compared as texts."""
    emit = {"": "u", "s": "u", "u": "a", "a": "u"}

    def with_inserts(table):
        for _ in range(4):
            for q in table:
                cost, audit = table[emit[q]]
                table[q] = min(table[q], (cost + 3, "I" + audit))
        return table

    far = (10**9, "")
    table = with_inserts({"": (0, ""), "a": (0, ""), "s": far, "u": far})
    for initial, kind in reversed(symbols):
        now = {}
        for q, (cost, audit) in table.items():
            ways = [(cost + 4, "D" + audit)]
            if kind in "-t":
                extra = 3 * (kind == "t")
                kept = initial if initial == emit[q] or (initial == "s" and q == "") else None
                if kept:
                    ways.append((table[kept][0] + extra, "K" + table[kept][1]))
                ways.append((table[emit[q]][0] + 3 + extra, "R" + table[emit[q]][1]))
            now[q] = min(ways)
        table = with_inserts(now)
    return table[""]


def plain(rows):
    """The report of one conversation of (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, symbols = set(), []
    for _, role, text in rows:
        symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault(role, text, seen)))
        seen.add((role, text))
    cost, audit = cheapest(symbols)
    lines, at, last = [], 0, ""
    for edit in audit:
        following = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
        if edit == "I":
            lines.append({"u": "user", "a": "assistant"}[following] + ":")
            last = following
            continue
        _, role, text = rows[at]
        at += 1
        if edit == "D":
            continue
        if edit == "R":
            role = {"u": "user", "a": "assistant"}[following]
        lines.append(f"{role}:{text}")
        last = role[0]
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    turns = [t for t, *_ in rows if t is not None]
    first = [i for i, _ in symbols]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(k == kind for _, k in symbols) for kind in "bdt"],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def result(frame):
    return {
        r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"])
        for r in frame.collect()
    }


def random_rows(chosen, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "umpire"]
    texts = ["One.", "Two!", "cut off", "", " \n", "So?", "more text", "Yes.\t", "end"]
    turn = lambda i: None if chosen.random() < 0.1 else i - chosen.randrange(2) + chosen.randrange(2) * 3
    return [(turn(i), chosen.choice(roles), chosen.choice(texts) + str(chosen.choice(["", "", i])) ) for i in range(n)]


def test_runs_and_powers_agree_with_all_suffixes():
    chosen = random.Random(3)
    for _ in range(600):
        symbols = []
        for _ in range(chosen.randrange(6)):
            symbols += [(chosen.choice("suax"), chosen.choice("--tbd"))] * chosen.choice([1, 1, 2, 5])
        runs = []
        for s in map("".join, symbols):
            if runs and runs[-1][0] == s:
                runs[-1] = (s, runs[-1][1] + 1)
            else:
                runs.append((s, 1))
        audit, cost, _ = cr.unroll(tuple(runs))
        assert (cost, audit) == cheapest(symbols)


def test_long_runs():
    for symbol in ("u-", "ut", "x-", "a-", "s-", "sd"):
        audit, cost, _ = cr.unroll(((symbol, 3000),))
        assert (cost, audit) == cheapest([tuple(symbol)] * 3000)
    n = 10**12  # only the costs: by powers
    assert cr._across("xd", n, cr.FINAL)[cr.START] == 4 * n
    assert cr._across("u-", n, cr.FINAL)[cr.START] == 3 * n // 2


@pytest.fixture(scope="module")
def awkward():
    chosen = random.Random(5)
    rows = {c: random_rows(chosen, chosen.randrange(1, 12)) for c in range(60)}
    rows[None] = random_rows(chosen, 5)
    rows[100] = random_rows(chosen, 700)  # most of the rows
    rows[101] = [(4, "user", "Same.")] * 300 + [(i, "user", "Same.") for i in range(100)]
    rows[102] = [(None, "assistant", ""), (None, "assistant", "")]
    rows[103] = [(0, "user", "word " * 60_000 + "end."), (1, "assistant", "x" * 300_000)]
    return rows


def check(spark, rows, split):
    data = [(c, *r, "x", 1) for c, of in rows.items() for r in of]
    random.Random(1).shuffle(data)
    repair = cr.Repair(spark.createDataFrame(data, SCHEMA).repartition(5))
    assert bool(repair.parts) == split
    assert result(repair.report()) == {c: plain(of) for c, of in rows.items()}
    return repair


def test_against_plain_version(spark, awkward):
    check(spark, awkward, split=False)


def test_conversation_over_many_partitions(spark, awkward):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 23)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        repair = check(spark, awkward, split=True)
        rows = repair.repaired().orderBy("part", "place").collect()
        for conv, of in awkward.items():
            lines = "\n".join(f"{r['role']}:{r['text']}" for r in rows if r["conv_id"] == conv)
            assert hashlib.sha256(lines.encode()).hexdigest() == plain(of)[-1]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_nulls_and_text_ids(spark):
    rows = [("a", None, None, None), ("a", 1, "user", None), (None, 2, None, "Hi."), ("b", 3, "user", "Hi.")]
    got = result(cr.Repair(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")).report())
    assert got == {
        "a": plain([(None, " ", " "), (1, "user", " ")]),
        None: plain([(2, " ", "Hi.")]),
        "b": plain([(3, "user", "Hi.")]),
    }


def test_empty_table(spark):
    frame = cr.Repair(spark.createDataFrame([], SCHEMA)).report()
    assert frame.collect() == []


def hurt(rows):
    """The damage of the query, row by row; None for conversations of which nothing stays."""
    out = {}
    for conv, turn, role, text in rows:
        of = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        of += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def test_query(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = result(QUERIES["op11_conversation_repair"](spark, tables))
    assert got == {c: plain(of) for c, of in hurt(rows).items()}


def test_damage_that_drops_everything(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi.", "x", 1), (None, None, "user", None, "x", 1), (1, None, None, "a", "x", 1)]
    frame, copies = cr.damaged(spark.createDataFrame(rows, SCHEMA))
    got = result(cr.Repair(frame, copies=copies).report())
    assert got == {c: plain(of) for c, of in hurt([r[:4] for r in rows]).items()}
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert frame.filter(F.col("copies") == 0).count() >= 1
