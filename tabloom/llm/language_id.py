"""Language of texts by averaged embeddings of hashed subwords.

A text is the average of the embeddings of its subwords: all sequences of one to
four letters inside a word, whose ends count as a letter, hashed to a fixed
number of buckets. A linear softmax over the average gives the language. Both
are trained by stochastic gradient descent in numpy, in one task, on a sample of
labelled texts of bounded size with equally many of each language; beside each
text the model learns from a short stretch of it, so that it knows short texts
too. A part of the sample is kept for calibration: a temperature makes scores
probabilities, and the least score that keeps errors below a stated share is the
limit under which a prediction is rejected.

Sampling, learning and predicting use hashes and fixed seeds only, so results
repeat. Whole texts are read, in blocks; predicting shuffles nothing. The model
that goes to all tasks has ``buckets * width`` numbers and as many rows of
weights as there are languages.

Defined cases: a null text, or one without a letter, has the language ``und``,
score 0 and is not accepted; a null language is not learned from; with no
labelled text every text is ``und``, with one language its score is 1; a null id
counts as an empty one when training rows are chosen; repeated rows have results
of their own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.sources.workspace import materialized

UNKNOWN = "und"
#: Texts the model is fitted on, at most.
SAMPLE = 6000
BUCKETS, WIDTH, LONGEST = 1 << 14, 16, 4
EPOCHS, RATE = 5, 0.3
#: One in so many sampled texts is for calibration only.
KEPT_BACK = 5
#: The share of wrong ones among accepted predictions the limit is chosen for.
ERRORS = 0.01
BLOCK = 1 << 20
BLANK = 0x20


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point its lower case, and whether it is a letter (2), a mark (1) or neither (0)."""
    lower, kind = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            kind[code] = 2
            small = char.lower()
            if len(small) == 1:
                lower[code] = ord(small)
        elif unicodedata.category(char)[0] == "M":
            kind[code] = 1
    return lower, kind


def _words(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Lower-case letters and marks with one blank between words, in blocks; how many of a block were in the one before."""
    lower, kind = _letters()
    tail = np.array([BLANK], np.uint32)
    for start in range(0, len(text) + 1, BLOCK):
        piece = text[start : start + BLOCK] + (" " if start + BLOCK > len(text) else "")
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = kind[codes] > 0
        codes = np.where(inside, lower[codes], np.uint32(BLANK))
        before = np.empty(len(inside), bool)
        before[1:], before[:1] = inside[:-1], tail[-1] != BLANK
        codes = codes[inside | before]
        yield np.concatenate([tail, codes]), len(tail)
        tail = np.concatenate([tail, codes])[-(LONGEST + 1) :]


def has_letter(text: str) -> bool:
    return any(char.isalpha() for char in text)


def subwords(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets (a power of two of them) of a text's subwords, and their shares."""
    counts = np.zeros(buckets, np.int64)
    down = np.uint32(33 - buckets.bit_length())
    for codes, seen in _words(text):
        blank = codes == BLANK
        mixed = codes * np.uint32(0x85EBCA6B)
        hashed, inner, found = np.zeros(len(codes) + 1, np.uint32), np.zeros(len(codes), bool), []
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            hashed = (hashed[:-1] ^ mixed[n - 1 :]) * np.uint32(0x9E3779B1)
            hashed ^= hashed >> np.uint32(15)
            if n > 2:
                inner = inner[:-1] | blank[n - 2 : -1]
            elif n == 2:
                inner = inner[:-1]
            first = max(0, seen - n + 1)  # earlier ones lie in the block before
            wanted = ~(blank if n == 1 else inner)[first:]
            salted = (hashed[first:][wanted] + np.uint32(n)) * np.uint32(0xC2B2AE35)
            found.append(salted >> down)
        if found:
            counts += np.bincount(np.concatenate(found), minlength=buckets)
    places = np.flatnonzero(counts)
    return places.astype(np.int32), (counts[places] / max(1, counts.sum())).astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    embeddings: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    temperature: float = 1.0
    limit: float = 0.0

    def logits(self, places: np.ndarray, shares: np.ndarray) -> np.ndarray:
        return self.weights @ (shares @ self.embeddings[places]) + self.shift

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated score, and whether the score reaches the limit."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        scores = _softmax(self.logits(*subwords(text, len(self.embeddings))) / self.temperature)
        best = int(scores.argmax())
        score = min(1.0, float(scores[best]))
        return self.languages[best], score, score >= self.limit


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _stretch(text: str, random: np.random.Generator) -> str:
    """Some words of a text."""
    start = int(random.integers(0, max(1, len(text) - 20)))
    words = text[start : start + 240].split()[1:]
    return " ".join(words[: int(random.integers(2, 16))])


def fit(texts: list[tuple[str, str]], buckets: int = BUCKETS, width: int = WIDTH, seed: int = 1) -> Model:
    """A model from texts and their languages; every KEPT_BACK-th one only calibrates."""
    random = np.random.default_rng(seed)
    languages = tuple(sorted({language for _, language in texts}))
    number = {language: i for i, language in enumerate(languages)}
    learned, kept = [], []
    for i, (text, language) in enumerate(texts):
        for part in (text, _stretch(text, random)):
            if has_letter(part):
                (kept if i % KEPT_BACK == 0 else learned).append((*subwords(part, buckets), number[language]))
    embeddings = (random.random((buckets, width), np.float32) - np.float32(0.5)) / width
    weights, shift = np.zeros((len(languages), width), np.float32), np.zeros(len(languages), np.float32)
    total, done = EPOCHS * len(learned), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(learned)):
            places, shares, language = learned[i]
            rate = np.float32(RATE * (1 - done / total))
            done += 1
            rows = embeddings[places]
            average = shares @ rows
            slope = _softmax(weights @ average + shift)
            slope[language] -= 1
            back = slope @ weights
            back /= max(np.float32(1), np.linalg.norm(back))
            weights -= rate * np.outer(slope, average)
            shift -= np.float32(0.1) * rate * slope
            # shares are small in long texts: the step is such that the average moves alike for all lengths
            embeddings[places] = rows - np.outer(rate * shares / (shares @ shares), back)
    model = Model(languages, embeddings, weights, shift)
    return _calibrated(model, kept or learned)


def _calibrated(model: Model, examples: list) -> Model:
    if not examples:
        return model
    z = np.array([model.logits(places, shares) for places, shares, _ in examples], float)
    truth = np.array([language for *_, language in examples])
    rows = np.arange(len(truth))
    loss = lambda t: -np.log(np.maximum(_softmax(z / t)[rows, truth], 1e-12)).mean()
    temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    scores = _softmax(z / temperature)
    best, right = scores.max(1), scores.argmax(1) == truth
    order = np.argsort(-best, kind="stable")
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(wrong <= ERRORS)
    limit = float(best[order[good[-1]]]) if len(good) else 1.0
    return Model(model.languages, model.embeddings, model.weights, model.shift, temperature, limit)


def training_rows(docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str, sample: int) -> DataFrame:
    """At most ``sample`` texts with their languages, equally many of each language where there are enough."""
    known = docs.select(
        docs[id_col].cast("string").alias("id"), docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"), train.alias("train")
    ).filter("train and lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return known.limit(0).select("id", "text", "lang")
    quota = max(1, sample // len(counts))
    known = known.withColumn("draw", F.xxhash64("id", "text", F.lit("sample")))
    # first a share of about twice the quota, then the quota exactly
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, 2 * (quota + 20) / n))])
    uniform = (F.col("draw").cast("double") / 2.0**64) + 0.5
    few = known.filter(uniform <= F.element_at(share, F.col("lang")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "text"))
    return few.withColumn("place", place).filter(F.col("place") <= quota).select("id", "text", "lang")


def learn(docs: DataFrame, train: Column, id_col="doc_id", text_col="text", lang_col="lang", sample: int = SAMPLE) -> Model:
    """A model from the labelled rows for which ``train`` holds."""
    drawn = materialized(training_rows(docs, train, id_col, text_col, lang_col, sample), "language-sample")

    def run(batches):
        rows = [(r["id"] or "", r["text"], r["lang"]) for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (hash_of(r[0]), r[2], r[1]))
        model = fit([(text, lang) for _, text, lang in rows])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([list(model.languages)], pa.list_(pa.string())),
                pa.array([np.concatenate([model.embeddings.ravel(), model.weights.ravel(), model.shift]).astype("<f4").tobytes()]),
                pa.array([model.temperature]),
                pa.array([model.limit]),
            ],
            names=["languages", "numbers", "temperature", "limit"],
        )

    fitted = drawn.coalesce(1).mapInArrow(run, "languages array<string>, numbers binary, temperature double, limit double")
    found = fitted.first()
    if found is None or not found["languages"]:
        return Model((), np.zeros((BUCKETS, WIDTH), np.float32), np.zeros((0, WIDTH), np.float32), np.zeros(0, np.float32))
    n, numbers = len(found["languages"]), np.frombuffer(bytes(found["numbers"]), "<f4")
    parts = np.split(numbers, [BUCKETS * WIDTH, BUCKETS * WIDTH + n * WIDTH])
    return Model(
        tuple(found["languages"]), parts[0].reshape(BUCKETS, WIDTH), parts[1].reshape(n, WIDTH), parts[2], found["temperature"], found["limit"]
    )


def hash_of(text: str) -> int:
    """A fixed order of ids that has nothing to do with their size."""
    value = 0xCBF29CE484222325
    for byte in text.encode("utf-8", "surrogatepass"):
        value = (value ^ byte) * 0x100000001B3 % 2**64
    return value


def identify(docs: DataFrame, model: Model, columns: list[Column], text_col: str = "text") -> DataFrame:
    """The given columns with ``lang_pred``, ``score`` and ``accepted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*columns).alias("kept"), docs[text_col].cast("string").alias("text"))
    kept = rows.schema["kept"].dataType

    def run(batches):
        model = shared.value
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column(1)]
            langs, scores, accepted = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["kept", "lang_pred", "score", "accepted"],
            )

    schema = f"kept {kept.simpleString()}, lang_pred string, score double, accepted boolean"
    return rows.mapInArrow(run, schema).select("kept.*", "lang_pred", "score", "accepted")


def held_out(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Rows of a fixed quarter of the ids, which are not learned from."""
    return F.crc32(F.coalesce(docs[id_col].cast("string"), F.lit("")).cast("binary")) % 4 == 2
