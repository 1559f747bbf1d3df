"""A support vector machine with a Gaussian kernel, and probabilities.

The kernel is approximated by random Fourier features: cosines of random
projections, whose inner products are the kernel's values in expectation. They
are matrix products over Arrow batches, so no pair of rows is ever compared; the
linear machine on them costs what a linear machine costs, whatever the number of
support vectors would be. Random features are made anew in each pass over the
rows, because they are many times as large as the rows; the machines of the
folds and that of all rows learn in the same passes. Margins become
probabilities by Platt scaling, fitted to margins of rows that the machine was
not trained on.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Generator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..sources.workspace import materialized

#: Random features; the error of a kernel value is about 1 / sqrt(SIZE).
SIZE = 256
#: Folds whose margins the probabilities are fitted to.
FOLDS = 3
#: Rows that are kept together, rows whose random features are held at once, results of tasks that the driver adds up itself.
BLOCK, SLICE, RESULTS = 2048, 256, 256


class RandomFourierFeatures(
    Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """A vector column lifted to features whose inner products approximate exp(-gamma * |x - y|^2).

    With gamma 0 it is 1 / the length of the vectors, which suits standardized
    columns. The projections follow from the seed, so nothing but parameters is saved.
    """

    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width, 0 for 1 / length", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, size=SIZE, gamma=0.0, seed=42):
        super().__init__()
        self._setDefault(size=SIZE, gamma=0.0, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size, seed, gamma = self.getOrDefault("size"), self.getOrDefault("seed"), self.getOrDefault("gamma")

        @F.arrow_udf("array<double>")
        def lifted(x: pa.Array) -> pa.Array:
            if not len(x):
                return pa.array([], pa.list_(pa.float64()))
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            weights, shift = projections(rows.shape[1], size, gamma, seed)
            out = cosines((rows @ weights + shift) / (2 * math.pi))
            out *= math.sqrt(2 / size)
            offsets = pa.array(np.arange(0, out.size + 1, size, dtype=np.int32))
            return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

        name = self.getOutputCol()
        return dataset.withColumn(name, array_to_vector(lifted(vector_to_array(F.col(self.getInputCol())))))


def projections(length: int, size: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    width = math.sqrt(2 * (gamma or 1 / max(length, 1)))
    return random.normal(size=(length, size)) * width, random.uniform(0, 2 * math.pi, size)


class PlattScaling(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` = 1 / (1 + exp(-(slope * margin + shift))) of a margin in ``rawPrediction``."""

    slope = Param(Params._dummy(), "slope", "factor of the margin", TypeConverters.toFloat)
    shift = Param(Params._dummy(), "shift", "added to the margin", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, slope=1.0, shift=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = vector_to_array("rawPrediction")[1]
        p = 1 / (1 + F.exp(-(margin * self.getOrDefault("slope") + self.getOrDefault("shift"))))
        return dataset.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def fit_platt(margins: DataFrame, steps: int = 30) -> tuple[float, float]:
    """Slope and shift for rows of ``margin`` and 0/1 ``label``, by Newton steps, each one aggregate.

    Labels are moved a little from 0 and 1, by how many there are of them, so
    that the fit exists for separable margins too; with one class it is flat.
    """
    counts = margins.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")).first()
    if not counts.p or not counts.n:
        return 0.0, math.log((counts.p + 1) / (counts.n + 1))
    target = F.when(F.col("label") == 1, (counts.p + 1) / (counts.p + 2)).otherwise(1 / (counts.n + 2))
    rows = margins.select("margin", target.alias("t"))
    slope, shift, loss = 0.0, math.log((counts.p + 1) / (counts.n + 1)), math.inf
    step = (0.0, 0.0)
    for _ in range(steps):
        z = F.col("margin") * float(slope) + F.lit(float(shift))
        p = 1 / (1 + F.exp(-z))
        w = p * (1 - p)
        cost = F.greatest(z, F.lit(0.0)) - z * F.col("t") + F.log1p(F.exp(-F.abs(z)))
        got = rows.agg(
            F.sum((F.col("t") - p) * F.col("margin")), F.sum(F.col("t") - p),
            F.sum(w * F.col("margin") * F.col("margin")), F.sum(w * F.col("margin")), F.sum(w), F.sum(cost),
        ).first()
        if got[5] > loss + 1e-9 * abs(loss):  # too long a step: half of it
            step = (step[0] / 2, step[1] / 2)
            slope, shift = slope - step[0], shift - step[1]
            continue
        gained, loss = loss - got[5], got[5]
        if gained < 1e-9 * max(abs(loss), 1):
            break
        bend = np.array([[got[2], got[3]], [got[3], got[4]]]) + 1e-10 * np.eye(2)
        step = tuple(float(v) for v in np.linalg.solve(bend, [got[0], got[1]]))
        slope, shift = slope + step[0], shift + step[1]
    return slope, shift


def fit_kernel_machine(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    penalty: float,
    weight: str | None = None,
    size: int = SIZE,
    gamma: float = 0.0,
    folds: int = FOLDS,
    seed: int = 42,
) -> PipelineModel:
    """Scaling, random features, linear machine and probabilities as one model.

    Folds follow from the hash of the features, so equal rows are held out together.
    """
    front = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="unscaled"),
            StandardScaler(inputCol="unscaled", outputCol="scaled", withMean=True, withStd=True),
            RandomFourierFeatures(inputCol="scaled", outputCol="features", size=size, gamma=gamma, seed=seed),
        ]
    ).fit(rows)
    columns = {"labelCol": label, "featuresCol": "features"} | ({"weightCol": weight} if weight else {})
    machine = LinearSVC(maxIter=100, tol=1e-4, regParam=penalty, standardization=False, **columns)
    passes = _Passes(rows, features, label, weight, front.stages[1], projections(len(features), size, gamma, seed), folds)
    try:
        fits = {part: passes.moments(part) for part in [*range(folds), None]}
        fits = {part: m for part, m in fits.items() if part is None or m.classes > 1}
        solved = _solved(passes, fits, penalty, machine.getMaxIter(), machine.getTol())
        held_out = {part: found for part, found in solved.items() if part is not None}
        slope, shift = fit_platt(materialized(passes.margins(rows, held_out), "margins")) if held_out else (1.0, 0.0)
    finally:
        passes.end()
    return PipelineModel(stages=[*front.stages, _model(rows, machine, *solved[None]), PlattScaling(slope=slope, shift=shift)])


def _model(rows: DataFrame, machine: LinearSVC, weights: np.ndarray, intercept: float) -> LinearSVCModel:
    context = rows.sparkSession.sparkContext
    model = LinearSVCModel(
        context._jvm.org.apache.spark.ml.classification.LinearSVCModel(machine.uid, _py2java(context, Vectors.dense(weights)), float(intercept))
    )
    return machine._copyValues(model)


class _Moments:
    """Weights, label counts, and means and standard deviations of the random features of the rows that a machine learns from."""

    def __init__(self, size: int, cells: np.ndarray):
        weight, squares, self.negatives, self.positives = cells[:4]
        self.weight, self.classes = weight, int(self.negatives > 0) + int(self.positives > 0)
        total, second = cells[4 : 4 + size], cells[4 + size :]
        mean = total / weight if weight else total * 0
        free = weight - squares / weight if weight else 0.0  # as MLlib counts weighted rows
        variance = np.maximum((second - weight * mean**2) / free, 0.0) if free > 0 else total * 0
        # a feature that does not vary leaves rounding errors only
        self.spread = np.where(variance > 1e-14 * mean**2, np.sqrt(variance), 0.0)
        self.unit = np.divide(1.0, self.spread, out=np.zeros(size), where=self.spread > 0)
        self.middle = mean * self.unit


def cosines(turns: np.ndarray) -> np.ndarray:
    """Cosines of angles given in turns, in their place; to the last few bits, and several times as fast as numpy's own."""
    turns -= np.rint(turns)
    np.abs(turns, out=turns)
    np.subtract(0.25, turns, out=turns)  # now the sine of what is within a quarter turn
    turns *= 2 * math.pi
    square = turns * turns
    total = np.full_like(turns, -1 / math.factorial(19))
    for degree in range(17, 0, -2):
        total *= square
        total += (-1) ** (degree // 2) / math.factorial(degree)
    turns *= total
    return turns


def _packed(part: np.ndarray, label: np.ndarray, weight: np.ndarray, x: np.ndarray) -> bytes:
    """Rows as bytes, each column in the smallest of three types that holds it exactly."""
    out: list = []
    for values in (part, label, weight, *x.T):
        with np.errstate(invalid="ignore", over="ignore"):
            kind = next(k for k in ("u1", "f4", "f8") if k == "f8" or np.array_equal(values.astype(k), values))
        out.append((kind, values.astype(kind).tobytes()))
    return pickle.dumps(out)


def _unpacked(block: bytes) -> tuple[np.ndarray, ...]:
    columns = [np.frombuffer(values, kind) for kind, values in pickle.loads(block)]
    x = np.empty((len(columns[0]), len(columns) - 3))
    for i, values in enumerate(columns[3:]):
        x[:, i] = values
    return *(c.astype(float) for c in columns[:3]), x


class _Passes:
    """Passes over the rows of a training table, kept as they are, each of which makes the random features of a few rows at a time."""

    def __init__(self, rows: DataFrame, features: Sequence[str], label: str, weight: str | None, scaler, lift, folds: int):
        part = F.pmod(F.xxhash64(*[col(c) for c in features]), F.lit(folds)).cast("int")
        weights = col(weight).cast("double") if weight else F.lit(1.0)
        x = [col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
        spread = scaler.std.toArray()
        unit = np.divide(1.0, spread, out=np.zeros(len(spread)), where=spread > 0)
        # scaling and turns instead of radians belong to the projection
        self.projection = unit[:, None] * lift[0] / (2 * math.pi)
        self.mean, self.shift = scaler.mean.toArray(), lift[1] / (2 * math.pi)
        self.size, self.folds = len(lift[1]), folds

        def pack(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    cut = batch.slice(at, BLOCK)
                    columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in cut.columns]
                    if not np.isin(columns[1], (0.0, 1.0)).all():
                        raise ValueError("labels have to be 0 or 1")
                    yield pa.RecordBatch.from_arrays([pa.array([_packed(*columns[:3], np.stack(columns[3:], axis=1))], pa.binary())], names=["block"])

        packed = rows.select(part.alias("part"), col(label).cast("double").alias("label"), weights.alias("weight"), *x).mapInArrow(pack, "block binary")
        self.blocks = packed.rdd.map(lambda row: bytes(row[0])).persist(StorageLevel.MEMORY_AND_DISK)
        self.cells = self._cells()

    def slices(self):
        """A function that takes a task's blocks to parts, labels, weights and random features of some rows."""
        mean, projection, shift, factor = self.mean, self.projection, self.shift, math.sqrt(2 / self.size)

        def run(blocks):
            for block in blocks:
                part, label, weight, x = _unpacked(block)
                x -= mean
                for at in range(0, len(x), SLICE):
                    cut = slice(at, at + SLICE)
                    turns = x[cut] @ projection
                    turns += shift
                    lifted = cosines(turns)
                    lifted *= factor
                    yield part[cut], label[cut], weight[cut], lifted

        return run

    def summed(self, length: int, measure) -> np.ndarray:
        """The sum over all rows of what ``measure`` gives for parts, labels, weights and random features: an array of this length.

        Sums are added in the order of tasks, so that a run can be repeated.
        """
        slices = self.slices()

        def run(task, blocks):
            total = np.zeros(length)
            for held in slices(blocks):
                total += measure(*held)
            yield task, total

        found = self.blocks.mapPartitionsWithIndex(run)
        while (tasks := found.getNumPartitions()) > RESULTS:
            near = found.map(lambda one: (one[0] // 16, one)).groupByKey(-(-tasks // 16), partitionFunc=int)
            found = near.map(lambda group: (group[0], sum(total for _, total in sorted(group[1], key=lambda one: one[0]))))
        return sum((total for _, total in sorted(found.collect(), key=lambda one: one[0])), np.zeros(length))

    def _cells(self) -> np.ndarray:
        size, folds = self.size, self.folds

        def measure(part, label, weight, lifted):
            out = np.zeros((folds, 4 + 2 * size))
            for p in range(folds):
                own = part == p
                w, x = weight[own], lifted[own]
                out[p] = [w.sum(), (w * w).sum(), (label[own] == 0).sum(), (label[own] == 1).sum(), *(w @ x), *(w @ (x * x))]
            return out.ravel()

        return self.summed(folds * (4 + 2 * size), measure).reshape(folds, -1)

    def moments(self, without: int | None) -> _Moments:
        return _Moments(self.size, self.cells[[p for p in range(self.folds) if p != without]].sum(axis=0))

    def losses(self, points: Mapping[int | None, tuple[np.ndarray, float]]) -> dict[int | None, tuple[float, float, np.ndarray]]:
        """Summed hinge loss of each machine, with the sums of its derivatives by margin, and by weight."""
        size, without = self.size, [-1 if part is None else part for part in points]
        weights, shifts = np.stack([w for w, _ in points.values()], axis=1), np.array([b for _, b in points.values()])

        def measure(part, label, weight, lifted):
            sign = (2 * label - 1)[:, None]
            short = 1 - sign * (lifted @ weights + shifts)
            w = np.where((short > 0) & (part[:, None] != np.array(without)), weight[:, None], 0.0)
            slope = -sign * w
            return np.concatenate([(short * w).sum(axis=0), slope.sum(axis=0), (slope.T @ lifted).ravel()])

        n = len(points)
        got = self.summed(n * (2 + size), measure)
        return {part: (got[i], got[n + i], got[2 * n + i * size : 2 * n + (i + 1) * size]) for i, part in enumerate(points)}

    def margins(self, rows: DataFrame, machines: Mapping[int, tuple[np.ndarray, float]]) -> DataFrame:
        """Labels and margins of the rows that a machine has not learned from."""
        slices = self.slices()

        def run(blocks):
            for part, label, _, lifted in slices(blocks):
                for p, (weights, intercept) in machines.items():
                    own = part == p
                    yield from zip(label[own].astype(int).tolist(), (lifted[own] @ weights + intercept).tolist())

        return rows.sparkSession.createDataFrame(self.blocks.mapPartitions(run), "label int, margin double")

    def end(self) -> None:
        self.blocks.unpersist()


def _solved(passes: _Passes, fits: Mapping[int | None, _Moments], penalty: float, steps: int, tolerance: float) -> dict:
    """Weights and intercept of each machine: hinge loss with an L2 penalty, all of them by the same passes."""
    size, done = passes.size, {}

    def place(m: _Moments, x: np.ndarray) -> tuple[np.ndarray, float]:
        return x[:size] * m.unit, x[size] - x[:size] @ m.middle

    def valued(m: _Moments, x: np.ndarray, loss: float, slope: float, slopes: np.ndarray) -> tuple[float, np.ndarray]:
        gradient = np.append(slopes * m.unit - slope * m.middle, slope) / m.weight
        plain = x[:size] * m.unit**2
        gradient[:size] += penalty * plain
        return loss / m.weight + 0.5 * penalty * float(x[:size] @ plain), gradient

    searches = {part: descent(np.zeros(size + 1), steps, tolerance) for part in fits}
    points = {part: next(search) for part, search in searches.items()}
    while points:
        found = passes.losses({part: place(fits[part], x) for part, x in points.items()})
        for part, x in [*points.items()]:
            try:
                points[part] = searches[part].send(valued(fits[part], x, *found[part]))
            except StopIteration as end:
                done[part] = place(fits[part], end.value)
                del points[part]
    return {part: done[part] for part in fits}


class _Stuck(Exception):
    """A direction along which no step can be found."""


def descent(start: np.ndarray, steps: int, tolerance: float, memory: int = 10) -> Generator:
    """Minimum by orthant-wise limited-memory quasi-Newton steps, as MLlib's linear machine takes them.

    Yields points, wants their value and gradient sent, and returns the last point.
    """
    x = start
    value, gradient = yield x
    first, pairs, values, failed, step = value, [], [], False, 0

    def direction():
        out = gradient.copy()
        if pairs:
            s, y = pairs[0]
            bend = s @ y
            if bend < 0 or math.isnan(bend):
                raise _Stuck
            diagonal, factors = bend / (y @ y), []
            for s, y in pairs:
                factors.append((s @ out) / (s @ y))
                if math.isnan(factors[-1]):
                    raise _Stuck
                out = out - factors[-1] * y
            out = out * diagonal
            for (s, y), a in zip(reversed(pairs), reversed(factors)):
                out = out + (a - (y @ out) / (s @ y)) * s
        out = -out
        return np.where(out * gradient < 0, out, 0.0)

    while True:
        converged = len(values) >= 2 and abs(value - max(values)) <= tolerance * first
        if step >= steps or converged or np.linalg.norm(gradient) <= max(tolerance * value, 1e-8):
            return x
        try:
            way = direction()
            orthant = np.where(x != 0, np.sign(x), np.sign(-gradient))
            fall, factor = way @ gradient, 0.1 if step < 1 else 0.5
            if not fall < 0:
                raise _Stuck
            # the library's search starts from the value where it stands, so its first size is always cut and never tried
            size = factor * (0.5 / np.linalg.norm(gradient) if step < 1 else 1.0)
            for trial in range(1, 20):
                moved = x + way * size
                moved = np.where(np.sign(moved) == np.sign(orthant), moved, 0.0)
                got, bent = yield moved
                along = bent @ way
                if got > value + size * fall * 1e-4 or along > -0.9 * fall:
                    change = factor
                elif along < 0.9 * fall:
                    change = 2.1
                else:
                    break
                if not 1e-10 <= size * change <= 1e10:
                    raise _Stuck
                if trial < 19:
                    size *= change
        except _Stuck:
            if failed:
                return x
            failed, pairs = True, []
            continue
        pairs = [(moved - x, bent - gradient), *pairs][:memory]
        x, value, gradient, step, failed = moved, got, bent, step + 1, False
        values = [*values, value][-20:]


def exchanged_confusion(model: PipelineModel, rows: DataFrame, features: Sequence[str]) -> DataFrame | None:
    """Confusion of a kernel machine for ``j`` -1, on features ``x``, and for each j, with x[j] taken from ``other``.

    Exchanging one feature moves the angles of a row by one row of the projection, so nothing but the cosines is computed again,
    and no row is copied. None for other models, and for other features than the model was fitted to.
    """
    kinds = [type(stage).__name__ for stage in model.stages]
    if kinds != ["VectorAssembler", "StandardScalerModel", "RandomFourierFeatures", "LinearSVCModel", "PlattScaling"]:
        return None
    if list(model.stages[0].getInputCols()) != list(features):
        return None
    width, lift, machine = len(features), model.stages[2], model.stages[3]
    projection, shift = projections(width, lift.getOrDefault("size"), lift.getOrDefault("gamma"), lift.getOrDefault("seed"))
    mean, spread = model.stages[1].mean.toArray(), model.stages[1].std.toArray()
    projection = np.divide(1.0, spread, out=np.zeros(width), where=spread > 0)[:, None] * projection / (2 * math.pi)
    shift, weights = shift / (2 * math.pi), machine.coefficients.toArray() * math.sqrt(2 / len(shift))
    intercept, threshold = machine.intercept, machine.getThreshold()

    def vectors(array: pa.Array) -> np.ndarray:
        flat = array.flatten()
        values = flat.to_numpy(zero_copy_only=False).reshape(-1, width)
        if flat.null_count or np.isnan(values).any():
            raise ValueError("features have missing values")
        return values

    def run(batches):
        total = np.zeros((width + 1, 4), np.int64)
        for batch in batches:
            label = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            every, others = vectors(batch.column(1)), vectors(batch.column(2))
            for at in range(0, len(label), SLICE):
                y, x, other = label[at : at + SLICE], every[at : at + SLICE], others[at : at + SLICE]
                turns = (x - mean) @ projection + shift
                own = cosines(turns.copy()) @ weights + intercept > threshold
                for j in range(-1, width):
                    guess = own
                    if j >= 0 and (moved := np.flatnonzero(x[:, j] != other[:, j])).size:
                        guess = own.copy()
                        apart = (other[moved, j] - x[moved, j])[:, None] * projection[j]
                        guess[moved] = cosines(turns[moved] + apart) @ weights + intercept > threshold
                    total[j + 1] += [((y == a) & (guess == b)).sum() for a, b in ((1, True), (0, True), (1, False), (0, False))]
        cells = [np.arange(-1, width, dtype=np.int32), *total.T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["j", "tp", "fp", "fn", "tn"])

    found = rows.select("label", "x", "other").mapInArrow(run, "j int, tp long, fp long, fn long, tn long")
    return found.groupBy("j").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])


def calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Per bin of scores in [0, 1]: rows, mean score and share of positives."""
    place = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(place.alias("bin")).agg(
        F.count("*").alias("row_count"), F.avg("score").alias("mean_score"), F.avg(F.col("label").cast("double")).alias("positive_share")
    )
