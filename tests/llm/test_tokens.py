"""Licenses, packing, token counts, byte-level BPE and the language model."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
from conftest import LONG, ODD, pairs
from tokenizers import Tokenizer

from tabloom.llm import byte_bpe, language_model, license_scan, packing, registered, token_counts
from tabloom.llm.common import row_groups

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# licenses


def _filler(rng, n):
    return " ".join(f"w{rng.randrange(500)}" for _ in range(n))


def test_licenses_are_found_where_they_stand():
    rng = random.Random(1)
    known = {n: license_scan.License(t, 0.8) for n, t in license_scan.LICENSES.items()}
    for name, text in license_scan.LICENSES.items():
        before, after = _filler(rng, 300), _filler(rng, 300)
        for body in (text, text.upper(), text.replace(" ", "\n  * ")):
            hits = [h for h in license_scan.scan(f"{before}. {body} {after}", known) if h[0] == name]
            assert len(hits) == 1 and hits[0][1] == 1.0
            assert hits[0][2] == len(before) + 2
        words = text.split()
        if len(words) > 30:  # some words changed, some left out
            changed = [w for i, w in enumerate(words) if i % 11] + []
            changed[7] = "altered"
            hits = [h for h in license_scan.scan(f"{before} {' '.join(changed)} {after}", known) if h[0] == name]
            assert len(hits) == 1 and 0.8 <= hits[0][1] < 0.95
    assert license_scan.scan(_filler(rng, 5000), known) == []
    notice = license_scan.LICENSES["MIT notice"]
    assert [h[0] for h in license_scan.scan(f"{notice}\n{notice}\n text {notice}", known)] == ["MIT notice"] * 3


def test_inserted_words_hide_no_license():
    rng = random.Random(3)
    known = {n: license_scan.License(t, 0.8) for n, t in license_scan.LICENSES.items()}
    words = license_scan.LICENSES["MIT"].split()
    before, after = _filler(rng, 400), _filler(rng, 400)
    blocks = [{len(words) // 2: n} for n in (80, 100, 1000)]  # one stretch, or a header again and again
    blocks += [{len(words) // 4: 100, 3 * len(words) // 4: 300}, {at: 20 for at in range(12, len(words), 12)}]
    for block in blocks:
        body = " ".join(x for i, w in enumerate(words) for x in ([_filler(rng, block[i])] if i in block else []) + [w])
        hits = license_scan.scan(f"{before}. {body} {after} {body}", known)
        assert [h[0] for h in hits] == ["MIT"] * 2
        if len(block) == 1:
            assert {h[1] for h in hits} == {1.0} and min(h[2] for h in hits) == len(before) + 2
    scattered = " ".join(f"{w} {_filler(rng, 60)}" for w in license_scan.LICENSES["MIT notice"].split())
    assert license_scan.scan(scattered, known) == []


def test_windows_at_the_beginning_are_all_tried():
    known = {"Apache": license_scan.License(license_scan.LICENSES["Apache-2.0 notice"], 0.8)}
    text = "Apache. Licensed under the Apache License, Version 2.0." + " licensed under the license version 2 0" * 2
    assert license_scan.scan(text, known)[0][:4] == ("Apache", 1.0, 8, 54)


def test_alignment_is_a_common_subsequence_with_all_anchors():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.choice("abcdefghij") for _ in range(rng.randrange(30))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randrange(30))]
        got = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    distinct = [f"w{i}" for i in range(50)]
    shuffled = distinct[25:] + distinct[:20]  # the longest rising run of unique words is the first half
    assert len(license_scan.align(distinct, shuffled)) == 25


def test_license_rows(spark, odd, documents):
    assert license_scan.find_licenses(odd).count() == 0
    assert license_scan.find_licenses(odd.limit(0)).count() == 0
    lines = {license_scan.LICENSES[n][:-1]: n for n in license_scan.LICENSES if n.endswith("notice")}
    rows = pairs(documents)
    got = {(r["doc_id"], r["license"], r["start_char"]) for r in license_scan.find_licenses(documents).collect()}
    want = {(i, n, m.start()) for i, t in rows for line, n in lines.items() for m in regex.finditer(regex.escape(line), t)}
    assert want and got == want


# packing


def _pieces(rows, got, size=2048):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    have = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    assert have == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), sum(r["length"] for r in got)


def _packed(docs, **options):
    pieces = packing.token_pieces(docs, TOKENIZER)
    return packing.pack(pieces.selectExpr("doc_id", "piece", "start", "length", "crc32(ids) AS ids_crc32"), **options)


def test_packing_of_odd_rows(odd):
    _pieces([(i, t) for i, t, *_ in ODD], _packed(odd).collect())
    assert _packed(odd.limit(0)).count() == 0


def test_packing_query_on_the_table(spark, tables, documents):
    n, tokens = _pieces(pairs(documents), registered.op3_best_fit_packing(spark, tables).collect())
    assert n <= math.ceil(tokens / 2048) + 1


def test_many_small_shards_cost_few_sequences(spark):
    rng = random.Random(5)
    lengths = [rng.randrange(1, 1200) for _ in range(3000)]
    items = spark.createDataFrame([(n,) for n in lengths], "length long")
    got = packing.pack(items, 2048, shard=100).collect()
    assert sorted(r["length"] for r in got) == sorted(lengths)
    least = math.ceil(sum(lengths) / 2048)
    assert len({r["sequence_id"] for r in got}) <= least * 1.02 + 1


def test_segment_tree_finds_the_tightest_room():
    rng = random.Random(6)
    for size in (1, 2, 7, 64, 100):
        lengths = [rng.randrange(1, size + 1) for _ in range(200)]
        number, offset, filled = packing.best_fit_decreasing(lengths, size)
        rooms, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [r for r in rooms if r >= lengths[i]]
            if fits:
                rooms.remove(min(fits))
            want[i] = min(fits, default=size)
            rooms.append(want[i] - lengths[i])
        assert all(size - offset[i] == want[i] for i in want)
        assert sorted(size - f for f in filled) == sorted(rooms)


def test_words_forgotten_are_encoded_again():
    own, fresh = packing.WordIds(TOKENIZER, remembered=5), Tokenizer.from_file(TOKENIZER)
    texts = ["a b c d e f g", "h i j k  l m", " a b c", "b c\n d", "", " ", "Don't   stop", "x " * 50] * 3
    for i in range(0, len(texts), 2):
        got = own.of(texts[i : i + 2])
        want = [np.array(fresh.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts[i : i + 2]]
        assert got == want


# token counts


@pytest.fixture(scope="module")
def scores():
    return token_counts.zipf_scores(RANKS)


def _token_rows(rows, scores):
    pattern, known, out = regex.compile(PATTERN), {}, []
    for i, t in rows:
        found = pattern.findall(t or "")
        for p in found:
            if p not in known:
                known[p] = brute.segmentation_tokens(p, scores)
        out.append((i, len(found), sum(known[p] for p in found)))
    return out


def test_token_counts(spark, odd, tables, documents, scores):
    rows = [(i, t) for i, t, *_ in ODD if i != 7]
    got = token_counts.count_tokens(odd.filter("doc_id IS NULL OR doc_id <> 7"), RANKS, PATTERN).collect()
    assert Counter(map(tuple, got)) == Counter(_token_rows(rows, scores))
    assert Counter(map(tuple, registered.op4_token_counts(spark, tables).collect())) == Counter(
        _token_rows(pairs(documents), scores)
    )
    assert token_counts.count_tokens(odd.limit(0), RANKS, PATTERN).count() == 0
    assert token_counts.count_tokens(odd.filter("doc_id = 7"), RANKS, PATTERN).first()["n_pretokens"] == 1


def test_trie_shares_prefixes():
    trie = token_counts.PieceTrie({b"a": -1.0, b"b": -1.0, b"ab": -1.5, b"abb": -3.5, b"c": -2.0})
    assert [trie.insert(w) for w in ("ab", "abb", "abab", "c", "")] == [1, 2, 2, 1, 0]
    assert len(trie.best) == 1 + len({"a", "ab", "abb", "aba", "abab", "c"})  # a node for each prefix
    assert trie.insert("axb") == 3  # a byte that is no piece


def test_a_trie_started_anew_counts_the_same(scores):
    words = "the same words counted again and again in another trie".split()
    kept, cleared = token_counts.PieceTrie(scores), token_counts.PieceTrie(scores)
    for _ in range(3):
        for word in words:
            if len(cleared.best) > 20:
                cleared.clear()
            assert kept.total([word, " " + word]) == cleared.total([word, " " + word])
    assert len(cleared.best) < len(kept.best)


# byte-level BPE


def test_encoding_and_decoding(spark, odd, tables, documents):
    own = byte_bpe.encoding(RANKS, PATTERN)

    def want(rows):
        for i, t in rows:
            ids = own.encode_ordinary(t or "")
            yield i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(t or "")

    coded = byte_bpe.encode(odd, RANKS, PATTERN)
    ids = Counter((r["doc_id"], r["n_tokens"], brute.sha(bytes(r["ids"]))) for r in coded.collect())
    rows = [(i, t) for i, t, *_ in ODD]
    assert ids == Counter(w[:3] for w in want(rows))
    data = Counter((r["doc_id"], bytes(r["data"]).decode()) for r in byte_bpe.decode(coded, RANKS, PATTERN).collect())
    assert data == Counter((i, t or "") for i, t in rows)
    assert Counter(map(tuple, registered.op6_byte_bpe(spark, tables).collect())) == Counter(want(pairs(documents)))
    assert byte_bpe.round_trip(odd.limit(0), RANKS, PATTERN).count() == 0


def test_cuts_change_no_ids():
    own, text = byte_bpe.encoding(RANKS, PATTERN), "".join(t or "" for _, t, *_ in ODD) + LONG[:5000]
    for size in (1, 7, 100, 4096):
        parts = byte_bpe.chunks(text[:20_000], size)
        assert "".join(parts) == text[:20_000]
        assert [i for p in parts for i in own.encode_ordinary(p)] == own.encode_ordinary(text[:20_000])


# language model


def _unigram(rows):
    def words(t):
        return [*brute.WORD.findall((t or "").translate(brute._LOWER)), ""]

    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if i is None or not out(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        own = words(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        yield (i, i is not None and out(i), len(own), sum(counts[w] > 0 for w in own), n), base


def _check_unigram(got, rows):
    key = lambda x: (x[0][0] is not None, x)
    have = sorted((((r[0], r[1], r[2], r[3], r[4]), r["base_score"]) for r in got), key=key)
    want = sorted(_unigram(rows), key=key)
    assert [h[0] for h in have] == [w[0] for w in want]
    assert all(abs(h[1] - w[1]) <= 1e-9 * abs(w[1]) + 1e-9 for h, w in zip(have, want))


def test_scores_of_the_table(spark, tables, documents):
    got = registered.op8_language_model(spark, tables).collect()
    _check_unigram(got, pairs(documents))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    again = registered.op8_language_model(spark, tables).collect()
    assert {r["doc_id"]: round(r["score"], 6) for r in got} == {r["doc_id"]: round(r["score"], 6) for r in again}


def test_rare_words_meet_their_counts_in_a_join(spark, documents, monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 50)  # nearly all words count as rare
    rows = documents.limit(60)
    _check_unigram(language_model.score(rows).collect(), pairs(rows))


def test_scores_of_odd_rows(spark, odd):
    got = language_model.score(odd).collect()
    _check_unigram(got, [(i, t) for i, t, *_ in ODD])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert language_model.score(odd.limit(0)).count() == 0
    nothing = language_model.score(odd.filter("doc_id = 1")).collect()  # held out: no training text
    assert nothing[0]["held_out"] is True and nothing[0]["train_tokens"] == 0 and nothing[0]["base_score"] == 0


def test_probabilities_sum_to_one():
    model = language_model.LogBilinear(np.arange(1.0, 41.0))
    rng = np.random.default_rng(0)
    for _ in range(20):
        model.train(rng.integers(0, 41, (500, 2)), rng.integers(0, 40, 500), rng)
    assert np.allclose((10 ** model.table().astype(float)).sum(axis=2), 1, atol=1e-4)


def test_training_learns_what_follows_what():
    """Each class follows the one before it; the model must prefer it to its frequency."""
    rng = np.random.default_rng(1)
    model = language_model.LogBilinear(np.full(20, 100.0))
    for _ in range(300):
        before = rng.integers(0, 20, (1000, 2))
        model.train(before, (before[:, 0] + 1) % 20, rng)
    table = 10 ** model.table().astype(float)
    assert min(table[i, j, (i + 1) % 20] for i in range(20) for j in range(20)) > 0.5


def _chains(rng, words, texts, length):
    """Texts in which each word follows the one before it in the list."""
    for i in range(texts):
        at = rng.randrange(len(words))
        yield i, " ".join(words[(at + k) % len(words)] for k in range(length))


@pytest.mark.parametrize("frequent", [1 << 20, 500])  # all words known to every task, or none
def test_words_without_a_class_of_their_own_are_told_apart(spark, monkeypatch, frequent):
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    rng = random.Random(5)
    rows = list(_chains(rng, [f"w{i:03}" for i in range(600)], 3000, 60))
    got = language_model.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    _check_unigram(got, rows)
    held = [r for r in got if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert gain > (0.4 if frequent > 500 else 0.015)


@pytest.mark.parametrize("frequent", [1 << 20, 300, 2])
def test_probabilities_of_all_words_sum_to_one(spark, monkeypatch, frequent):
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    counts = {f"w{i:03}".encode(): 1 + 3000 // (i + 1) for i in range(900)} | {b"": 4000}
    known = language_model.vocabulary(spark.createDataFrame([*counts.items()], "word binary, n long"))
    rng, words = np.random.default_rng(3), [*counts, b"never seen"]
    numbers, classes, places, digests = known.placed(words)
    rows = language_model.context_rows(classes, places, np.arange(len(words)) // 9 * 9, known)
    own = language_model.LogBilinear(known.class_counts, known.slots)
    for _ in range(5):
        own.train(rows, classes, rng)
    inside = {c: language_model.WordsInside(n) for c, n in known.inside.items()}
    for c, words_in in inside.items():
        words_in.train(own.predicted(rows[classes == c]), places[classes == c], rng)
    model = language_model.Model(own, {c: words_in.parts for c, words_in in inside.items()})
    before, rare, groups = np.tile(rows[5], (len(words), 1)), numbers < 0, language_model.Groups.of(known)
    found = 10 ** model.log_shares(before, classes, places)
    asked = groups.tokens(digests, before[rare])
    learned = groups.tokens(digests, rows[rare]).repeat(np.array([*counts.values(), 0])[rare])
    learned["learn"] = 1
    for group in np.unique(asked["group"]):
        of_group = asked["group"] == group
        both = np.concatenate([asked[of_group], learned[learned["group"] == group]])
        share = language_model._scored_inside(both, own, known.other)[2]
        found[np.flatnonzero(rare)[of_group]] *= 10 ** share[: of_group.sum()]
    assert abs(found.sum() - 1) < 1e-4 and (found > 0).all()


def _own_encoding():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.mark.parametrize("blank", [" ", "\n", " \n", "　\t", "\x85 "])
@pytest.mark.parametrize("shape", ["{}", "{}word", "word{}", "one{}two", "a{}'s b{}9{}!\n", "{}x y{}", "ends in mark.{}— dash"])
def test_long_runs_of_blanks_are_as_in_the_library(blank, shape):
    ranks, pattern = _own_encoding()
    own = byte_bpe.encoding(ranks, pattern)
    for n in (byte_bpe.RUN - 1, byte_bpe.RUN, byte_bpe.RUN + 1, 3 * byte_bpe.RUN):
        text = shape.format(*[(blank * n)[:n]] * 3)
        assert byte_bpe.encode_text(text, ranks, pattern).tolist() == own.encode_ordinary(text)


def test_two_million_blanks(spark):
    """The library itself fails on these."""
    ranks, pattern = _own_encoding()
    run = " " * 2_000_000
    texts = [run, run + "end", "start" + run, "one" + run + "two" + "\n" * 1_000_001 + "three", run[:-1] + "\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_tokens"], bytes(r["data"])) for r in byte_bpe.round_trip(docs, ranks, pattern).collect()}
    assert all(found[i][1] == text.encode() for i, text in enumerate(texts))
    own = byte_bpe.encoding(ranks, pattern)
    short = len(own.encode_ordinary("one" + " " * 1000 + "two" + "\n" * 1001 + "three"))
    assert found[3][0] - short == 2_000_000 - 1000 + len(own._encode_single_piece(b"\n" * 1_000_000)) - len(own._encode_single_piece(b"\n" * 1000))


def test_very_long_pretokens_are_scored_outside_the_trie(monkeypatch):
    trie = token_counts.PieceTrie(token_counts.zipf_scores(RANKS))
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé北 ") for _ in range(rng.randrange(1, 400))) for _ in range(60)] + ["the" * 900, "x" * 3000]
    inside = [trie.insert(w) for w in words]
    monkeypatch.setattr(token_counts, "IN_TRIE", 0)
    nodes = len(trie.best)
    assert [trie.insert(w) for w in words] == inside and len(trie.best) == nodes
    trie.clear()
    assert trie.total(words + words[:5]) == sum(inside) + sum(inside[:5]) and not trie.counts


def test_memory_of_a_long_pretoken():
    import tracemalloc

    trie = token_counts.PieceTrie(token_counts.zipf_scores(RANKS))
    word = "longword" * 40_000
    tracemalloc.start()
    trie.total([word])
    assert tracemalloc.get_traced_memory()[1] < 3 * len(word) + 200_000
    tracemalloc.stop()


def _columns_of_texts():
    rows = ["", " ", "a", "A b", " x\n", "\x0b\x0c\r\ty\x1c z\x85q w", "ÄÖ Éa", "", "word\x00x", "北京 X  Y ", "end", ""]
    for column in (pa.array(rows), pa.array(rows, pa.large_string()), pa.array(rows).slice(3, 6), pa.array(["", ""])):
        yield column
    yield pa.array([], pa.string())


@pytest.mark.parametrize("most", [1, 9, 1 << 20])
def test_words_cut_from_columns(most):
    for column in _columns_of_texts():
        found = []
        for part in row_groups(column, most):
            words, lengths = language_model.cut_words(part)
            ends = np.cumsum(lengths).tolist()
            found += [words.to_pylist()[a:b] for a, b in zip([0, *ends], ends)]
        assert found == [[*t.translate(brute._LOWER).encode().split(), b""] for t in column.to_pylist()]


def test_words_are_placed_without_work_for_each_token():
    """A word costs Python once for all of its tokens in a column."""
    known = language_model.Vocabulary(pa.array([b"", b"the"]), np.array([9, 5]), np.array([1, 2]), np.array([0, 0]), 20, 4)
    words = pa.array([b"the", b"rare", b"", b"rare", b"other"] * 200_000)
    calls = []

    def count(frame, event, _):
        calls.append(event)

    sys.setprofile(count)
    try:
        numbers, classes, _, digests = known.placed(words)
    finally:
        sys.setprofile(None)
    assert len(calls) < 1000
    assert numbers[:5].tolist() == [1, -1, 0, -1, -1] and classes[:5].tolist() == [2, 0, 1, 0, 0]
    want = [np.frombuffer(hashlib.blake2b(w, digest_size=16).digest(), "<u8").tolist() for w in (b"rare", b"rare", b"other")]
    assert digests[:3].tolist() == want and len(digests) == 600_000


def test_units_have_the_ids_of_the_library():
    rng = random.Random(8)
    own = packing.WordIds(TOKENIZER, remembered=500)
    bits = [*"aZé北9½.,'!\"(<|>_-", *[" "] * 4, "  ", "\n", "\n\n", "\r\n", "\t", " \n", "\n ", "\x85", "\xa0", "\u3000", "\u2009"]
    bits += ["\u200b", "\x1c", "\x00", "\x7f", "'s", "'ll", "\u0301", "\ufeff", "😀", "<|endoftext|>", "\x0b", "\x0c", "١", "word", " end"]
    for _ in range(60):
        batch = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(100)]
        want = [np.array(own.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in batch]
        assert own.of(batch) == want and own.of(pa.array(["first", *batch])[1:]) == want
    assert own.of([]) == [] and own.of(["", ""]) == [b"", b""]


def test_words_are_remembered_without_marks():
    own, marks = packing.WordIds(TOKENIZER), [".", ",", ";", "!", ".\n", ",\n", "?\"", ")", "\n", ""]
    own.of([f"A {word}{mark} end" for word in ("thonre", "ertionhe", "hotiné") for mark in marks])
    assert len([unit for unit in own.young if b"thonre" in unit or b"ertionhe" in unit]) == 2
