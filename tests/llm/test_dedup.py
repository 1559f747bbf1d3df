"""Exact, line and near deduplication."""

import random

import brute
import numpy as np
import pytest
from conftest import LONG, ODD, pairs
from pyspark.sql import functions as F

from tabloom.llm import components, exact_dedup, line_dedup, registered, simhash
from tabloom.sources.workspace import new_path


def _key(row):
    return tuple((v is not None, v) for v in row)


def test_exact_decisions(odd):
    got = exact_dedup.decide(odd, exact_dedup.fresh_index(odd), "odd").collect()
    assert len(got) == len(ODD)
    by_text = {}
    for i, t, *_ in ODD:
        by_text.setdefault(t or "", []).append(i)
    for r in got:
        ids = next(v for k, v in by_text.items() if brute.sha(k) == bytes(r["digest"]).hex())
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    assert sum(r["kept"] for r in got) == len(by_text)  # one row of each text, of repeated rows too
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_rows_keep_their_columns(odd):
    kept = exact_dedup.drop_copies(odd, exact_dedup.fresh_index(odd), "odd")
    assert kept.schema.names == odd.schema.names
    rows = kept.collect()
    assert len(rows) == len({t or "" for _, t, *_ in ODD})
    assert {r["doc_id"] for r in rows if r["text"] == LONG} == {6}


def test_index_outlives_the_batch(spark, odd):
    path = new_path(spark, "index")
    index = exact_dedup.open_index(spark, path)
    first = odd.filter("doc_id < 8")
    assert exact_dedup.drop_copies(first, index, "first").count() == 5  # texts 1=2, 3, 4, 5=6, 7
    spark.sql(f"DROP TABLE {index}")  # the folder stays
    again = exact_dedup.open_index(spark, path)
    more = exact_dedup.decide(odd, again, "odd").collect()
    kept = {r["doc_id"] for r in more if r["kept"]}
    assert not kept & {1, 2, 3, 4, 5, 6, 7} and {8, 9, 20, 22} <= kept
    assert {r["keep_id"] for r in more if r["doc_id"] in (5, 6)} == {6}
    assert exact_dedup.drop_copies(odd, again, "odd again").count() == 0
    joined = spark.table(again).select("digest").hint("merge").join(spark.table(again).hint("merge"), "digest")
    assert f"SelectedBucketsCount: {exact_dedup.BUCKETS}" in joined._jdf.queryExecution().toString()


def test_lines(odd):
    got = line_dedup.drop_common_lines(odd).collect()
    want = brute.without_common_lines([(i, t) for i, t, *_ in ODD])
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got), key=_key) == sorted(want, key=_key)


def test_line_query_on_the_table(spark, tables, documents):
    got = registered.op7_line_dedup(spark, tables).collect()
    want = [(i, n, d, brute.sha(t)) for i, n, d, t in brute.without_common_lines(pairs(documents))]
    assert sorted(map(tuple, got)) == sorted(want)
    plan = registered.op7_line_dedup(spark, tables)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_and_components(odd):
    got = simhash.near_duplicates(odd).collect()
    prints = [brute.simhash(t) for _, t, *_ in ODD]
    roots = brute.linked(len(ODD), brute.near_links(prints, 2))
    ids = [i for i, *_ in ODD]
    lowest = {}
    for place, root in enumerate(roots):
        if ids[place] is not None:
            lowest[root] = min(lowest.get(root, ids[place]), ids[place])
    want = [(i, f"{p:016x}", lowest.get(r)) for i, p, r in zip(ids, prints, roots)]
    have = [(r["doc_id"], bytes(r["fingerprint"]).hex(), r["component_id"]) for r in got]
    assert sorted(have, key=_key) == sorted(want, key=_key)


def test_simhash_query_on_the_table(spark, tables, documents):
    got = {r["doc_id"]: r for r in registered.op5_simhash_near_dedup(spark, tables).collect()}
    rows = sorted(pairs(documents))
    prints = [brute.simhash(t) for _, t in rows]
    roots = brute.linked(len(rows), brute.near_links(prints, 2))
    assert len(got) == len(rows)
    for (i, _), p, root in zip(rows, prints, roots):
        assert got[i]["fingerprint"] == f"{p:016x}" and got[i]["component_id"] == rows[root][0]


@pytest.mark.parametrize("parts, tile", [(4, 8192), (4, 3), (1, 50), (2, 7)])
def test_every_link_counts_whatever_the_tiles(spark, parts, tile):
    """Clumps of fingerprints around shared centres, in many small tiles."""
    rng = random.Random(parts * 100 + tile)
    centres = [rng.getrandbits(64) for _ in range(20)] + [0, (1 << 64) - 1]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(15)})
    rows = [(i, bytearray(p.to_bytes(8, "big"))) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, fingerprint binary").repartition(4)
    links = simhash.links(nodes, 1, 2, 2, parts, tile).collect()
    want = brute.linked(len(prints), brute.near_links(prints, 2))
    assert brute.linked(len(prints), [(r["a"], r["b"]) for r in links]) == want
    roots = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert [roots.get(i, i) for i in range(len(prints))] == want


def test_a_clump_gives_a_forest(spark):
    prints = [1 << b for b in range(60)]  # all within two bits of each other
    nodes = spark.createDataFrame(
        [(i, bytearray(p.to_bytes(8, "big"))) for i, p in enumerate(prints)], "node long, fingerprint binary"
    )
    assert simhash.links(nodes, 1, 2, 2, 4, 16).count() < 8 * len(prints)


def test_components_of_a_chain(spark):
    order = list(range(200))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    got = components.components(edges).collect()
    assert len(got) == 200 and {r["root"] for r in got} == {0}


def test_similarity_of_wide_fingerprints():
    """Texts that share 80 % of their shingles link, texts that share 60 % don't."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]

    def changed(share):  # one stretch of other words: n shingles minus what the stretch touches
        n = int(596 * (1 - share) / (1 + share)) - 4
        return words[:100] + [f"v{rng.randrange(10**6)}" for _ in range(n)] + words[100 + n :]

    one = np.frombuffer(simhash.fingerprint(" ".join(words), 5, 16), ">u8").astype(np.uint64)
    distance = lambda t: int(np.bitwise_count(one ^ np.frombuffer(simhash.fingerprint(" ".join(t), 5, 16), ">u8").astype(np.uint64)).sum())  # noqa: E731, E501
    assert distance(changed(0.85)) <= 172 < distance(changed(0.6))


def test_near_duplicates_leave_one(odd):
    kept = simhash.keep_one(odd)
    assert kept.schema.names == odd.schema.names
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    assert ids.count(5) == 1 and 6 not in ids  # equal long texts, a repeated row among them
    assert 21 in ids and 22 not in ids and None in ids and 9 in ids


def test_near_copies_of_a_table(spark, documents):
    """A few changed words are caught; texts without copies stay."""
    base = documents.dropDuplicates(["text"]).filter("length(text) > 1500").limit(40)
    base = spark.createDataFrame(base.collect(), base.schema)
    alone = {r["doc_id"] for r in simhash.keep_one(base).collect()}
    copies = base.withColumn("doc_id", F.col("doc_id") + 10**6).withColumn(
        "text", F.concat(F.lit("Changed beginning "), F.substring("text", 12, 10**7), F.lit(" and end"))
    )
    assert {r["doc_id"] for r in simhash.keep_one(base.unionByName(copies)).collect()} == alone


def _altered(rng, words, share):
    """A text whose set of shingles has about this similarity: one stretch is replaced."""
    n = round((len(words) - 4) * (1 - share) / (1 + share)) - 4
    at = rng.randrange(5, len(words) - n - 5)
    return words[:at] + [f"v{rng.randrange(10**9)}" for _ in range(n)] + words[at + n :]


@pytest.mark.parametrize("tile", [simhash.SET_TILE, 3])
def test_links_are_those_of_brute_force_similarity(spark, monkeypatch, tile):
    """Similarities around 0.8, most of which a distance alone can't tell apart; also in many small tiles."""
    monkeypatch.setattr(simhash.similar_links, "__defaults__", (tile,))
    rng, rows = random.Random(5), []
    for share in [0.70, 0.74, 0.76, 0.78, 0.79, 0.795, 0.805, 0.81, 0.82, 0.85, 0.9] * 4:
        words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(_altered(rng, words, share)))]
    clump = [f"c{rng.randrange(10**6)}" for _ in range(300)]
    for share in [0.76] * 10 + [0.9] * 10:
        rows.append((len(rows), " ".join(_altered(rng, clump, share))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == brute.kept_by_jaccard(rows)


def test_repeats_count_once_and_short_texts_are_found(spark):
    """Sets of shingles decide, whatever is repeated; ten words and one more are 0.857 alike."""
    rng, rows = random.Random(6), []

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def add(*texts):
        rows.extend((len(rows) + k, " ".join(t)) for k, t in enumerate(texts))

    for n, repeats in ((100, 18), (100, 18), (500, 90), (500, 90)):
        own = words(n)
        add(own, own + ["again"] * repeats)
    for n in [3, 5, 8, 9, 10, 10, 10, 12, 15, 20, 30, 36, 37, 40, 44] * 4:
        own = words(n)
        add(own, own + words(1), own + words(3))
    common = words(12)  # a passage of many short texts that are not alike
    add(*[common + words(9) for _ in range(30)], *[words(9) + common for _ in range(30)])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == brute.kept_by_jaccard(rows)


@pytest.mark.parametrize("tile", [simhash.TILE, 2, 5])
def test_blocks_of_common_and_rare_shingles(spark, monkeypatch, tile):
    """A passage of most texts, clumps of near copies, sets of all sizes; tasks that call nearly all shingles common, or none."""
    monkeypatch.setattr(simhash.block_links, "__defaults__", (tile,))
    rng, rows = random.Random(8), []

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    passage = words(70)
    for n in [6, 12, 30, 60, 100, 150, 220, 300]:
        for _ in range(6):
            own = words(n)
            texts = [own + passage, own[: n // 2] + words(n // 12 + 1) + own[n // 2 :] + passage, words(n // 2) + passage]
            rows += [(len(rows) + k, " ".join(t)) for k, t in enumerate(texts)]
    clump = words(200)
    rows += [(len(rows) + k, " ".join(_altered(rng, clump, 0.9))) for k in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute.kept_by_jaccard(rows)
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == want
    for limits in ((0.0, 0), (10.0**9, 0)):
        monkeypatch.setattr(simhash.common_shingles, "__defaults__", limits)
        assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == want


def test_rarest_shingles_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    weights = rng.integers(0, 5, simhash.BUCKETS)
    for n in [1, 2, 4, 5, 9, 10, 25, 100, 333] * 10:
        both = rng.integers(0, 2**63, n, dtype=np.uint64)
        apart = int(n / 0.8 - n + 1e-9)  # at most so many shingles are in one set only
        cut = int(rng.integers(0, apart + 1))
        a = np.unique(np.r_[both, rng.integers(0, 2**63, cut, dtype=np.uint64)])
        b = np.unique(np.r_[both, rng.integers(0, 2**63, apart - cut, dtype=np.uint64)])
        assert simhash.similar(a, b, 0.8)
        assert set(simhash.rarest_shingles(a, 0.8, weights)) & set(simhash.rarest_shingles(b, 0.8, weights))
    assert len(simhash.rarest_shingles(both[:0], 0.8, weights)) == 0


def test_one_row_of_a_group_without_ids_stays(spark):
    words = [f"w{i}" for i in range(60)]
    text, more, most = " ".join(words), " ".join([*words, "more"]), " ".join([*words, "even", "more"])
    docs = spark.createDataFrame([(None, text), (None, more), (None, most), (None, "a text of its own")], "doc_id long, text string")
    kept = [r["text"] for r in simhash.keep_one(docs).collect()]
    assert len(kept) == 2 and "a text of its own" in kept
    named = docs.unionByName(spark.createDataFrame([(5, most + " again")], docs.schema))
    assert {r["doc_id"] for r in simhash.keep_one(named).collect()} == {None, 5}


def test_near_stage_on_the_table(spark, documents):
    distinct = documents.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    rows = pairs(distinct)
    assert {r["doc_id"] for r in simhash.keep_one(distinct).collect()} == brute.kept_by_jaccard(rows)


def test_a_batch_that_runs_again_keeps_the_same_rows(spark, odd):
    """As after a failure behind the append: nothing is taken for a copy of itself, and nothing is appended twice."""
    index = exact_dedup.fresh_index(odd, buckets=5)
    first = exact_dedup.drop_copies(odd, index, "monday")  # its result is never read
    appended = spark.table(index).count()
    again = exact_dedup.drop_copies(odd, index, "monday")
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect())) and again.count() == appended
    assert spark.table(index).count() == appended == spark.table(index).select("digest").distinct().count()
    decided = exact_dedup.decide(odd, index, "monday")
    assert decided.filter("kept").count() == appended and spark.table(index).count() == appended
    assert exact_dedup.drop_copies(odd, index, "tuesday").count() == 0


def test_an_append_that_fails_is_repeated(spark, odd, monkeypatch):
    index, append = exact_dedup.fresh_index(odd), exact_dedup._append

    def broken(groups, index, batch):
        append(groups, index, batch)
        raise RuntimeError("lost after the append")

    monkeypatch.setattr(exact_dedup, "_append", broken)
    with pytest.raises(RuntimeError):
        exact_dedup.drop_copies(odd, index, "monday")
    monkeypatch.undo()
    texts = {t or "" for _, t in pairs(odd)}
    assert exact_dedup.drop_copies(odd, index, "monday").count() == len(texts)


def test_empty_tables(odd):
    none = odd.limit(0)
    assert exact_dedup.decide(none, exact_dedup.fresh_index(none), "none").count() == 0
    assert exact_dedup.drop_copies(none, exact_dedup.fresh_index(none), "none").count() == 0
    assert line_dedup.drop_common_lines(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
