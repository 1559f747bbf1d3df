import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import language_id as li
from tabloom.llm.registered import QUERIES


def plain_subwords(text):
    """How many subwords a text has, and its words as they are looked at."""
    small = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c for c in text)
    words = "".join(c if c.isalpha() or unicodedata.category(c)[0] == "M" else " " for c in small).split()
    grams = []
    for word in words:
        marked = f" {word} "
        grams += list(word)
        grams += [marked[i : i + n] for n in (2, 3, 4) for i in range(len(marked) - n + 1)]
    return grams


def test_subwords_do_not_depend_on_blocks(monkeypatch):
    for text in ("Hello, wörld 12 a", "", "x", " ab ", "x" * 100, "a b c " * 50, "नमस्ते दुनिया", "İstanbul ß", "12 !?"):
        whole = li.subwords(text)
        for size in (1, 2, 3, 7):
            monkeypatch.setattr(li, "BLOCK", size)
            places, shares = li.subwords(text)
            assert (places == whole[0]).all() and np.allclose(shares, whole[1])
        monkeypatch.undo()
        grams = plain_subwords(text)
        assert len(whole[0]) <= len(set(grams)) and len(whole[0]) >= 0.9 * len(set(grams))
        counts = whole[1] * max(1, len(grams))
        assert np.allclose(counts, np.round(counts), atol=1e-3)
        assert round(float(counts.sum())) == len(grams)


def test_query_on_held_out_rows(spark, tables, documents):
    rows = QUERIES["op12_language_id"](spark, tables).collect()
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in documents.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]][0] for r in held]) >= 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert rows == QUERIES["op12_language_id"](spark, tables).collect()  # repeatable


def test_learning_ignores_held_out_rows(spark, documents):
    held = li.held_out(documents)
    other = documents.withColumn("lang", F.when(~held, documents["lang"]).otherwise("zz"))
    a, b = (li.learn(d, ~li.held_out(d)) for d in (documents, other))
    assert a.languages == b.languages and (a.embeddings == b.embeddings).all() and a.limit == b.limit


def _texts(n):
    words = {"aa": ["kato", "mira", "sotu", "lena"], "bb": ["grüß", "schön", "über", "zwölf"], "cc": ["なに", "これ", "それ", "あれ"]}
    random = np.random.default_rng(4)
    return [(" ".join(random.choice(words[lang], random.integers(3, 30))), lang) for i in range(n) for lang in words]


def test_scores_are_calibrated_and_strange_texts_rejected():
    model = li.fit(_texts(120))
    fresh = _texts(160)[-150:]
    found = [model.predict(text) for text, _ in fresh]
    assert np.mean([lang == truth for (lang, *_), (_, truth) in zip(found, fresh)]) >= 0.98
    right = np.mean([lang == truth for (lang, _, good), (_, truth) in zip(found, fresh) if good])
    assert right >= 1 - li.ERRORS - 0.01
    assert not model.predict("щдф жюя")[2]  # none of its subwords were seen
    assert model.predict("12 !?") == ("und", 0.0, False)


def test_noisy_labels_lower_the_scores():
    random = np.random.default_rng(8)
    texts = [(text, str(random.choice(["aa", "bb"])) if lang != "cc" else lang) for text, lang in _texts(150)]
    model = li.fit(texts)
    scores = [model.predict(text)[1] for text, lang in texts if lang != "cc"]
    assert 0.4 < np.mean(scores) < 0.75


def test_sample_is_bounded_and_even(spark, documents):
    train = ~li.held_out(documents)
    drawn = li.training_rows(documents, train, "doc_id", "text", "lang", 40).groupBy("lang").count().collect()
    assert sum(r["count"] for r in drawn) <= 40 and all(r["count"] <= 10 for r in drawn)


def test_odd_rows(spark, odd):
    model = li.learn(odd, ~li.held_out(odd))
    rows = li.identify(odd, model, [odd["doc_id"], odd["text"], odd["kept"], odd["whole"]]).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
        else:
            assert r["lang_pred"] in model.languages and 0 <= r["score"] <= 1


def test_no_labels_one_language_and_empty_tables(spark, odd):
    unlabelled = odd.selectExpr("doc_id", "text", "cast(null as string) as lang")
    model = li.learn(unlabelled, ~li.held_out(unlabelled))
    assert {r["lang_pred"] for r in li.identify(unlabelled, model, [unlabelled["doc_id"]]).collect()} == {"und"}
    one = odd.selectExpr("doc_id", "text", "'q' as lang")
    model = li.learn(one, ~li.held_out(one))
    assert {(r["lang_pred"], r["score"]) for r in li.identify(one, model, [one["doc_id"]]).collect()} == {("q", 1.0), ("und", 0.0)}
    assert li.identify(odd.limit(0), model, [odd["doc_id"]]).collect() == []


@pytest.mark.parametrize("text", ["a" * 3_000_000, "wort " * 400_000])
def test_very_long_texts(text):
    places, shares = li.subwords(text)
    assert abs(float(shares.sum()) - 1) < 1e-3 and len(places) < 30
