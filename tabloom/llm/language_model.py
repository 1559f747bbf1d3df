"""Scoring texts with a log-bilinear language model.

Words of the training texts are counted over the whole corpus. A word's
probability has two factors: that of its class, and that of the word among the
words of its class. Both come from an embedding that the two words before
predict, whose products with class and word embeddings are scores; both are
normalised, so probabilities of all words, with one place for unseen ones, sum to
one in any context. Every word of the training texts has parameters of its own.

Classes follow frequency. The most frequent words and the end of a text are
classes of one; the words after them share classes of bounded size and share of
the tokens. These words have more than one in FREQUENT tokens, so there are fewer
than FREQUENT of them, whatever the corpus, and every task knows them. All other
words are one class, dealt by their digest (128 bits) into groups, as many as
there are words for. A group has its smoothed share of that class, and inside it
words have embeddings again. As context, a frequent word is the sum of the
embeddings of its class and of its place there, a pair no other word has; other
words are told apart by their digest, as far as there are places.

First, each task trains on its own texts with numpy by noise-contrastive
estimation, noise drawn from the frequencies of classes or of words in a class;
parameters are averaged by the number of tokens they have seen. With them, texts
are scored where they are read. Only tokens of words that are not frequent go to
the task of their group, which counts them, estimates their embeddings in the
same way, contexts fixed, and scores them.

Defined cases: a null or empty text is its end alone; a null id belongs to the
training texts; repeated rows are texts of their own; without training texts
every token has count zero and the model is that of the counts; other columns
have no effect; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import BLANKS, distinct, row_groups, stretches, texts, utf8
from tabloom.sources.workspace import materialized

#: Words of which more than one in so many tokens is one are known to every task.
FREQUENT = 1 << 20
#: Words that are classes of one; the words after them share classes.
CLASSES = 126
#: A class of several words has at most one in so many tokens,
SHARE = 64
#: and at most so many words, or twice the root of the number of frequent words; a group of others has about as many.
WORDS = 256
#: Tokens of several groups that one task sees together, about.
SHARD = 1 << 17
WIDTH = 24
NOISE = 64
BATCH = 2048
RATE = 0.15
SEED = 7
#: Tasks whose parameters are averaged in one step.
MERGED = 64
OTHER, END = 0, 1
#: Fixed point of averaged parameters, so that the order of additions has no effect.
UNIT = 1 << 44
_END_WORD = b""  # no word is empty
#: A token of a word that is not frequent on its way to its group; ``key`` is the word's digest.
TOKEN = np.dtype([("group", "<u4"), ("learn", "u1"), ("row", "<i8"), ("before", "<u2", 4), ("key", "<u8", 2)])
#: Tokens a task holds before it trains inside classes, or sends them, and scores at once.
HELD = 1 << 18
#: Bytes of text that are cut into words at once, and those whose words are counted at once.
TEXT, COUNTED = 1 << 21, 1 << 23
#: Tokens that are put in random order together.
SHUFFLED = 1 << 16
#: Whether a byte belongs to a word.
_IN_WORD = ~np.isin(np.arange(256), list(BLANKS.encode()))


def held_out(doc_id: Column) -> Column:
    """The remainder of the id's checksum decides; the same for any table the row is in."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _edges(inside: np.ndarray, starts: np.ndarray, last: bool) -> np.ndarray:
    """Places of the first, or last, byte of each word; a word ends with its text."""
    found, own = inside.copy(), starts[:-1][starts[:-1] < starts[1:]]
    if last:
        found[:-1] &= ~inside[1:]
        own = starts[1:][starts[:-1] < starts[1:]] - 1
    else:
        found[1:] &= ~inside[:-1]
    found[own] = inside[own]
    return np.flatnonzero(found)


def cut_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of some texts, and how many each text has."""
    data, starts = utf8(column)
    inside = _IN_WORD[data]
    begins, ends = _edges(inside, starts, False), _edges(inside, starts, True) + 1
    bounds = np.searchsorted(begins, starts)
    lengths = np.insert(ends - begins, bounds[1:], 0)  # an end after the words of each text
    return stretches(data[inside].tobytes().lower(), lengths), np.diff(bounds) + 1


def count_words(documents: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all texts; tasks count before anything is shuffled."""

    def run(batches):
        for batch in batches:
            for part in row_groups(batch.column(0), COUNTED):
                counted = cut_words(part)[0].value_counts()
                yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], ["word", "n"])

    counted = documents.select("text").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task knows: frequent words with their counts, classes and places there, and the totals."""

    words: pa.Array
    counts: np.ndarray
    classes: np.ndarray
    places: np.ndarray
    n: int
    distinct: int

    @property
    def class_counts(self) -> np.ndarray:
        """Tokens of each class, at least one."""
        found = np.bincount(self.classes, self.counts, minlength=END + 1)
        found[OTHER] = self.other[0]
        return np.maximum(found, 1.0)

    @property
    def other(self) -> tuple[int, int]:
        """Tokens and distinct words that are not frequent."""
        return int(self.n - self.counts.sum()), int(self.distinct - len(self.counts))

    @property
    def slots(self) -> int:
        """Places of the largest class."""
        return max(WORDS, int(self.places.max(initial=0)) + 1)

    @property
    def inside(self) -> dict[int, np.ndarray]:
        """The counts of the words of each class that has several."""
        order = np.argsort(self.classes, kind="stable")
        bounds = np.searchsorted(self.classes[order], np.arange(END + 1, len(self.class_counts)))
        by_class = enumerate(np.split(self.counts[order], bounds)[1:], END + 1)
        return {c: counts for c, counts in by_class if len(counts) > 1}

    def placed(self, words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number (-1: not frequent), class and place of each word, and digests of those that are not frequent."""
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        numbers = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        missing = np.flatnonzero(numbers < 0)
        rare, which = distinct(words.take(pa.array(missing)))
        raw = b"".join([hashlib.blake2b(word, digest_size=16).digest() for word in rare])
        digests = np.frombuffer(raw, "<u8").reshape(-1, 2).take(which, axis=0)
        classes, places = np.full(len(words), OTHER), np.zeros(len(words), np.int64)
        if len(self.classes):
            classes, places = self.classes.take(numbers), self.places.take(numbers)
            classes[missing] = OTHER
        places[missing] = digests[:, 0] % np.uint64(self.slots)
        return numbers, classes, places, digests


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    n, distinct = total[0] or 0, total[1]
    frequent = counts.filter(F.col("n") * FREQUENT > n).collect()  # fewer than FREQUENT rows
    frequent = sorted(((r["n"], bytes(r["word"])) for r in frequent), key=lambda x: (-x[0], x[1]))
    classes, places = np.zeros(len(frequent), np.int64), np.zeros(len(frequent), np.int64)
    most = max(WORDS, 2 * int(np.sqrt(len(frequent))))
    last, alone, size, mass = END, 0, 0, 0
    for i, (count, word) in enumerate(frequent):
        if word == _END_WORD:
            classes[i] = END
            continue
        if alone < CLASSES or not size or size >= most or (mass + count) * SHARE > n:
            last, size, mass = last + 1, 0, 0
        classes[i], places[i] = last, size
        if alone < CLASSES:
            alone += 1
        else:
            size, mass = size + 1, mass + count
    words = pa.array([word for _, word in frequent], pa.binary())
    return Vocabulary(words, np.array([c for c, _ in frequent], np.int64), classes, places, n, distinct)


@dataclass
class Groups:
    """How many groups of words that are not frequent there are, and in how many buckets they are shuffled."""

    number: int
    buckets: int

    @classmethod
    def of(cls, known: Vocabulary) -> Groups:
        tokens, words = known.other
        return cls(max(1, -(-words // WORDS), -(-2 * tokens // SHARD)), max(1, -(-tokens // SHARD)))

    def tokens(self, digests: np.ndarray, before: np.ndarray) -> np.ndarray:
        found = np.zeros(len(digests), TOKEN)
        found["group"], found["key"], found["before"] = digests[:, 1] % np.uint64(self.number), digests, before
        return found


def _mixed(*columns: np.ndarray) -> np.ndarray:
    out = np.full(len(columns[0]), SEED, np.uint64)
    for column in columns:
        out = (out ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


@lru_cache(maxsize=32)
def _flat(rows: int) -> np.ndarray:
    return np.arange(rows * WIDTH).reshape(rows, WIDTH)


def _sums(rows: np.ndarray, values: np.ndarray, like: np.ndarray) -> np.ndarray:
    flat = _flat(1 << len(like).bit_length()).take(rows, axis=0).ravel()
    return np.bincount(flat, values.ravel(), minlength=like.size).reshape(like.shape)


def _falling(x: np.ndarray, height: float = 1) -> np.ndarray:
    """``height / (1 + exp(x))`` in the place of its argument."""
    with np.errstate(over="ignore"):  # then it is 0
        np.exp(x, out=x)
    x += 1
    return np.divide(np.float32(height), x, out=x)


def contrast(q, b, unigram, predicted, target, random) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Noise-contrastive estimation: steps of embeddings and biases, and of each predicted embedding."""
    noise = np.searchsorted(np.cumsum(unigram), random.random(NOISE)).clip(max=len(unigram) - 1)
    shift = b - (np.log(unigram) + np.log(NOISE)).astype(np.float32)
    own, other = q.take(target, axis=0), q.take(noise, axis=0)
    up = np.einsum("ij,ij->i", predicted, own)
    up += shift.take(target)
    up = _falling(up)
    down = predicted @ -other.T
    down -= shift[noise]
    down = _falling(down, -1)
    step = _sums(target, up[:, None] * predicted, q) + _sums(noise, down.T @ predicted, q)
    bias_step = np.bincount(target, up, minlength=len(b))
    bias_step += np.bincount(noise, np.ones(len(down), np.float32) @ down, minlength=len(b))
    own *= up[:, None]
    own += down @ other
    return step, bias_step, own


def log_sums(q, b, predicted) -> np.ndarray:
    """The logarithm that normalises the scores of each predicted embedding."""
    out = np.empty(len(predicted), np.float64)
    most, ones = max(64, (1 << 17) // len(q)), np.ones(len(q), np.float32)
    weights = np.concatenate([q, b[:, None]], axis=1, dtype=np.float32).T.copy()
    wide = np.ones((len(predicted), WIDTH + 1), np.float32)  # the last place takes the bias
    wide[:, :WIDTH] = predicted
    squares, longest, largest = np.einsum("ij,ij->i", predicted, predicted), np.einsum("ij,ij->i", q, q).max(), np.abs(b).max()
    for i in range(0, len(predicted), most):
        scores = wide[i : i + most] @ weights
        if largest + np.sqrt(longest * squares[i : i + most].max()) < 60:  # exp is in range
            out[i : i + most] = np.log(np.exp(scores, out=scores) @ ones)
        else:
            top = scores.max(axis=1, keepdims=True)
            scores -= top
            out[i : i + most] = top[:, 0] + np.log(np.exp(scores, out=scores) @ ones)
    return out


def log_shares(q, b, predicted, target, sums=None) -> np.ndarray:
    """log10 of the normalised probability of each target."""
    own = np.einsum("ij,ij->i", predicted, q.take(target, axis=0)) + b.take(target)
    return (own - (log_sums(q, b, predicted) if sums is None else sums)) / np.log(10)


def _by_class(classes: np.ndarray, chosen: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The chosen tokens of each class."""
    places = np.flatnonzero(chosen[classes])
    if not len(places):
        return []
    places = places[np.argsort(classes[places].astype(np.int16), kind="stable")]
    found = classes[places]
    starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return list(zip(found[starts].tolist(), np.split(places, starts[1:])))


class WordsInside:
    """Embeddings and biases of the words of a class or group, estimated with contexts fixed; it starts from the counts."""

    def __init__(self, counts: np.ndarray):
        self.unigram = counts / counts.sum()
        self.parts = [np.zeros((len(counts), WIDTH), np.float32), np.log(self.unigram).astype(np.float32)]
        self.seen = [np.full(p.shape, 1e-2, np.float32) for p in self.parts]

    def train(self, predicted: np.ndarray, target: np.ndarray, random) -> None:
        for i in range(0, len(target), BATCH):
            own, wanted = predicted[i : i + BATCH], target[i : i + BATCH]
            steps = contrast(*self.parts, self.unigram, own, wanted, random)
            for p, seen, step in zip(self.parts, self.seen, steps):
                _adapted(p, seen, (step / len(wanted)).astype(np.float32))


def _adapted(p: np.ndarray, seen: np.ndarray, gradient: np.ndarray) -> None:
    seen += gradient * gradient
    p += RATE * gradient / np.sqrt(seen)


class LogBilinear:
    """Class embeddings, context embeddings with a weight for each position, and biases.

    Contexts are given by rows of context embeddings, first those of the word
    just before, then as many of the one before it. The first rows are the
    classes and "before the text", the others places in a class.
    """

    def __init__(self, class_counts: np.ndarray, slots: int = 0):
        random = np.random.default_rng(SEED)
        k = len(class_counts)
        self.unigram = class_counts / class_counts.sum()
        self.parts = {
            "target": random.normal(0, 0.1, (k, WIDTH)),
            "context": random.normal(0, 0.1, (k + 1, WIDTH)),  # the last is "before the text"
            "position": np.ones((2, WIDTH)),
            "bias": np.log(self.unigram),
        }
        if slots:
            places = random.normal(0, 0.1, (slots + 1, WIDTH))
            self.parts["context"] = np.concatenate([self.parts["context"], places])
        self.parts = {name: p.astype(np.float32) for name, p in self.parts.items()}
        self.seen = {name: np.full(p.shape, 1e-2, np.float32) for name, p in self.parts.items()}

    def vector(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts.values()])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for name, p in self.parts.items():
            self.parts[name] = vector[at : at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size

    def words_before(self, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The context embeddings of the two words before each token."""
        r, half = self.parts["context"], before.shape[1] // 2
        found = []
        for columns in (before.T[:half], before.T[half:]):
            found.append(r.take(columns[0], axis=0))
            for rows in columns[1:]:
                found[-1] += r.take(rows, axis=0)
        return found[0], found[1]

    def predicted(self, before: np.ndarray) -> np.ndarray:
        one, two = self.words_before(before)
        one *= self.parts["position"][0]
        two *= self.parts["position"][1]
        one += two
        return one

    def train(self, before: np.ndarray, target: np.ndarray, random) -> None:
        """One step of noise-contrastive estimation; ``before`` holds the context rows before each target."""
        q, r, c, b = self.parts["target"], self.parts["context"], self.parts["position"], self.parts["bias"]
        size, half = np.float32(len(target)), before.shape[1] // 2
        one, two = self.words_before(before)
        target_step, bias_step, back = contrast(q, b, self.unigram, c[0] * one + c[1] * two, target, random)
        summed = back.astype(np.float64)
        context_step = sum(c[i // half] * _sums(rows, summed, r) for i, rows in enumerate(before.T))
        position_step = np.stack([(back * one).sum(0), (back * two).sum(0)])
        for name, step in (("target", target_step), ("context", context_step), ("position", position_step), ("bias", bias_step)):
            _adapted(self.parts[name], self.seen[name], (step / size).astype(np.float32))

    def table(self) -> np.ndarray:
        """log10 of the probability of each class (last axis) after each two classes."""
        q, r, c, b = self.parts["target"], self.parts["context"], self.parts["position"], self.parts["bias"]
        out = np.empty((len(r), len(r), len(q)), np.float32)
        for i in range(len(r)):
            scores = (c[0] * r[i] + c[1] * r) @ q.T + b
            top = scores.max(axis=1, keepdims=True)
            scores -= top + np.log(np.exp(scores - top).sum(axis=1, keepdims=True))
            out[i] = scores / np.log(10)
        return out


def _contexts(values: np.ndarray, start: np.ndarray, begin: int) -> np.ndarray:
    """The two values before each token; ``start`` has the place of its text's first token."""
    places = np.arange(len(values))
    one = np.where(places - 1 >= start, np.r_[begin, values[:-1]], begin)
    two = np.where(places - 2 >= start, np.r_[begin, begin, values[:-2]][: len(values)], begin)
    return np.stack([one, two], axis=1)


def context_rows(classes: np.ndarray, places: np.ndarray, start: np.ndarray, known: Vocabulary) -> np.ndarray:
    """Rows of context embeddings: class and place of the word before, then of the one before that."""
    k = len(known.class_counts)
    by_class, by_place = _contexts(classes, start, k), _contexts(places, start, known.slots) + k + 1
    return np.stack([by_class[:, 0], by_place[:, 0], by_class[:, 1], by_place[:, 1]], axis=1)


def _firsts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the first token of each text, and the same for each token."""
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return first, np.repeat(first, lengths)


@dataclass
class Model:
    """The model of classes, and embeddings and biases inside each class of several words."""

    classes: LogBilinear
    inside: dict[int, list[np.ndarray]]

    def log_shares(self, before: np.ndarray, classes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token; of one that is not frequent, that of its class."""
        codes = np.zeros(len(before), np.int64)
        for rows in before.T:
            codes = codes << 15 | rows
        found = pa.array(codes).dictionary_encode()  # contexts repeat
        once, back = found.dictionary.to_numpy(), found.indices.to_numpy()
        columns = range(before.shape[1])
        predicted = self.classes.predicted(np.stack([once >> 15 * i & (1 << 15) - 1 for i in reversed(columns)], axis=1))
        parts = self.classes.parts["target"], self.classes.parts["bias"]
        sums = log_sums(*parts, predicted).take(back)
        predicted = predicted.take(back, axis=0)
        out = log_shares(*parts, predicted, classes, sums)
        several = np.zeros(len(self.classes.unigram), bool)
        several[list(self.inside)] = True
        for c, own in _by_class(classes, several):
            out[own] += log_shares(*self.inside[c], predicted.take(own, axis=0), places.take(own))
        return out


def _averaged(table: pa.Table) -> pa.Table:
    """Parameters of several tasks, weighted by the tokens they have seen, always in the same order."""
    table = table.sort_by("task")
    trained = [x.as_py() for x in table.column("trained")]
    total = sum(np.frombuffer(x.as_py(), "<f4") * np.float64(n) for x, n in zip(table.column("part"), trained))
    part = (total / sum(trained)).astype("<f4").tobytes()
    return pa.table(
        {"class": table.column("class")[:1], "task": pa.array([table.column("task")[0].as_py() // MERGED], pa.int64()),
         "trained": pa.array([sum(trained)], pa.int64()), "part": pa.array([part], pa.binary())}
    )


def train(documents: DataFrame, known: Vocabulary) -> Model:
    """The average of the models that tasks have trained on their own texts."""
    model = LogBilinear(known.class_counts, known.slots)
    counted = known.inside
    inside = {c: WordsInside(counts).parts for c, counts in counted.items()}
    if not known.n:
        return Model(model, inside)
    shared = documents.sparkSession.sparkContext.broadcast((known, counted))
    schema = "class int, task long, trained long, part binary"

    def run(batches):
        known, counted = shared.value
        own = LogBilinear(known.class_counts, known.slots)
        words_in = {c: WordsInside(counts) for c, counts in counted.items()}
        several = np.zeros(len(own.unigram), bool)
        several[list(counted)] = True
        random, trained, held, waiting = np.random.default_rng(SEED), Counter(), [], 0

        def train_inside():
            classes, places, before = (np.concatenate(x) for x in zip(*held))
            for c, chosen in _by_class(classes, several):
                words_in[c].train(own.predicted(before.take(chosen, axis=0)), places.take(chosen), random)
                trained[c] += len(chosen)

        for batch in batches:
            for part in row_groups(batch.column(0), TEXT):
                words, lengths = cut_words(part)
                _, all_classes, all_places, _ = known.placed(words)
                rows = context_rows(all_classes, all_places, _firsts(lengths)[1], known)
                for at in range(0, len(rows), SHUFFLED):
                    order = at + random.permutation(min(SHUFFLED, len(rows) - at))
                    before, classes, places = rows.take(order, axis=0), all_classes.take(order), all_places.take(order)
                    for i in range(0, len(order), BATCH):
                        own.train(before[i : i + BATCH], classes[i : i + BATCH], random)
                    trained[OTHER] += len(order)
                    chosen = np.flatnonzero(several[classes])
                    held.append((classes.take(chosen), places.take(chosen), before.take(chosen, axis=0)))
                    waiting += len(chosen)
                    if waiting >= HELD:
                        train_inside()
                        held, waiting = [], 0
        if held:
            train_inside()
        task = TaskContext.get().partitionId()
        for c, n in sorted(trained.items()):  # the model of classes goes by the number of the class without words
            vector = own.vector() if c == OTHER else np.concatenate([p.ravel() for p in words_in[c].parts])
            row = [[c], [task], [n], [vector.astype("<f4").tobytes()]]
            types = pa.int32(), pa.int64(), pa.int64(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], ["class", "task", "trained", "part"])

    parts = documents.select("text").mapInArrow(run, schema)
    some = parts.groupBy("class", F.floor(F.col("task") / MERGED).alias("step")).applyInArrow(_averaged, schema)
    for row in some.groupBy("class").applyInArrow(_averaged, schema).collect():  # a row for each class
        vector = np.frombuffer(row["part"], "<f4")
        if row["class"] == OTHER:
            model.load(vector)
        else:
            words = len(vector) // (WIDTH + 1)
            inside[row["class"]] = [vector[:-words].reshape(-1, WIDTH), vector[-words:]]
    return Model(model, inside)


def _sent(held: list[np.ndarray], buckets: int, schema: pa.Schema) -> pa.RecordBatch:
    """The tokens by bucket, a row for each."""
    found = np.concatenate(held)
    bucket = found["group"] % buckets
    order = np.argsort(bucket, kind="stable")
    found, bucket = found[order], bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    data = [part.tobytes() for part in np.split(found, starts[1:])]
    columns = {"bucket": pa.array(bucket[starts], pa.int64()), "data": pa.array(data, pa.binary())}
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(data), f.type)) for f in schema], schema=schema)


def _scored_inside(found: np.ndarray, model: LogBilinear, other: tuple[int, int]):
    """For each token of a group: whether training has seen it, what its count adds to the base, its log share of its class."""
    predicted, learn = model.predicted(found["before"]), found["learn"] > 0
    high, low = (np.unique(found["key"][:, i], return_inverse=True)[1] for i in (0, 1))
    target = np.unique(high * (low.max() + 1) + low, return_inverse=True)[1]
    counts = np.bincount(target, learn)
    seen, known = counts > 0, counts[target] > 0
    places = float(other[0] + other[1] + 1)  # one more for words that training has not seen
    base, score = np.zeros(len(found)), np.full(len(found), -np.log10(places))
    if seen.any():
        target, counted = (np.cumsum(seen) - 1)[target], counts[seen] + 1.0
        inside = WordsInside(counted)
        inside.train(predicted[learn], target[learn], np.random.default_rng(SEED))
        base[known] = np.log10(counted[target[known]])
        score[known] = log_shares(*inside.parts, predicted[known], target[known]) + np.log10(counted.sum() / places)
    return known, base, score


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of its tokens, the unigram ``base_score`` and the model's ``score``.

    Both are log10 probabilities of the whole text. The model learns from the
    documents that are not held out.
    """
    documents = texts(docs, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))
    learned = documents.filter(~F.col("held_out"))
    known = vocabulary(materialized(count_words(learned), "word-counts"))
    model, groups = train(learned, known), Groups.of(known)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((known, model, groups))
    contexts = context.broadcast((model.classes, known.other))
    id_type = documents.schema["doc_id"].dataType.simpleString()
    partial = f"row long, doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base double, score double"

    def run(batches):
        known, model, groups = shared.value
        all_base = np.log10(known.n + known.distinct + 1.0)
        logs = np.log10(np.r_[known.counts, 0] + 1.0)  # the last is for words that are not frequent
        held, waiting, schema = [], 0, None
        for batch in batches:
            at = 0
            schema = pa.schema(
                [pa.field("row", pa.int64()), pa.field("doc_id", batch.schema.field("doc_id").type),
                 pa.field("held_out", pa.bool_()), pa.field("n_tokens", pa.int64()), pa.field("n_known", pa.int64()),
                 pa.field("base", pa.float64()), pa.field("score", pa.float64()), pa.field("bucket", pa.int64()),
                 pa.field("data", pa.binary())]
            )
            rows, outs = batch.column("row").to_numpy(), batch.column("held_out").to_numpy(zero_copy_only=False)
            for part in row_groups(batch.column("text"), TEXT):
                words, lengths = cut_words(part)
                numbers, classes, places, digests = known.placed(words)
                first, start = _firsts(lengths)
                before = context_rows(classes, places, start, known)
                missing = numbers < 0
                slices = [slice(i, i + HELD) for i in range(0, len(before), HELD)]
                modelled = np.concatenate([model.log_shares(before[i], classes[i], places[i]) for i in slices])
                count = len(lengths)
                row, out = rows[at : at + count], outs[at : at + count]
                found = groups.tokens(digests, before[missing])
                found["learn"], found["row"] = np.repeat(~out, lengths)[missing], np.repeat(row, lengths)[missing]
                held.append(found)
                waiting += len(held[-1])
                columns = [
                    pa.array(row),
                    batch.column("doc_id").slice(at, count),
                    batch.column("held_out").slice(at, count),
                    pa.array(lengths, pa.int64()),
                    pa.array(np.add.reduceat((~missing).astype(np.int64), first)),
                    pa.array(np.add.reduceat(logs[numbers] - all_base, first)),
                    pa.array(np.add.reduceat(modelled, first)),
                    pa.array(row % groups.buckets),
                    pa.nulls(count, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                at += count
                if waiting >= HELD:
                    yield _sent(held, groups.buckets, schema)
                    held, waiting = [], 0
        if waiting:
            yield _sent(held, groups.buckets, schema)

    def finish(table: pa.Table) -> pa.Table:
        model, other = contexts.value
        whole = table.filter(table.column("data").is_null()).drop_columns(["bucket", "data"])
        found = np.frombuffer(b"".join(x.as_py() for x in table.column("data").drop_null()), TOKEN)
        if not len(found):
            return whole
        keys = (found["key"][:, 0], found["key"][:, 1], *found["before"].T, found["learn"])
        found = found[np.lexsort((_mixed(*keys), found["group"]))]  # the same order however rows arrive
        group = found["group"]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        parts = [_scored_inside(part, model, other) for part in np.split(found, starts[1:])]
        rows, place = np.unique(found["row"], return_inverse=True)
        news, base, modelled = (np.bincount(place, np.concatenate(x)) for x in zip(*parts))
        columns = {
            "row": pa.array(rows),
            "n_known": pa.array(news.astype(np.int64)),
            "base": pa.array(base),
            "score": pa.array(modelled),
        }
        fields = whole.schema
        added = pa.Table.from_arrays([columns.get(f.name, pa.nulls(len(rows), f.type)) for f in fields], schema=fields)
        return pa.concat_tables([whole, added])

    dealt = (
        documents.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(run, f"{partial}, bucket long, data binary")
        .repartition(groups.buckets, "bucket")
    )
    scored = dealt.groupBy("bucket").applyInArrow(finish, partial).groupBy("row")
    kept = [F.first(name, ignorenulls=True).alias(name) for name in ("doc_id", "held_out", "n_tokens")]
    whole = scored.agg(*kept, F.sum("n_known").alias("n_known"), F.sum("base").alias("base"), F.sum("score").alias("score"))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(known.n).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
