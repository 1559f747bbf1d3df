"""Principal components of wide tables, and rows projected to them.

The matrix of all pairs of columns is never made: a randomized range finder
multiplies the standardized rows with a few random directions and back, which is
two matrix products per Arrow batch. A few such passes leave the space of the
largest components; the last pass finds them in it. What a task sends, and what
the driver holds, is columns times directions. Components have unit length and
their largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from .profiling import per_column

#: Directions beyond those wanted, and passes that sharpen them.
EXTRA, PASSES = 10, 4


@dataclass(frozen=True)
class Projection:
    """Column means and spreads, and the components: unit vectors, and the shares of all variance they explain."""

    features: tuple[str, ...]
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    shares: tuple[float, ...]


def _standardized(array: pa.Array, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    x = array.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean))
    return (np.where(np.isnan(x), mean, x) - mean) / spread


def _products(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """A'A times the directions, for the standardized rows A; one pass."""
    d, k = directions.shape

    def multiply(batches):
        total, seen = np.zeros((d, k)), False
        for batch in batches:
            a = _standardized(batch.column(0), mean, spread)
            total += a.T @ (a @ directions)
            seen = True
        if seen:
            values = pa.ListArray.from_arrays(np.arange(0, d * k + 1, k, dtype=np.int32), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), values], names=["i", "v"])

    sent = rows.mapInArrow(multiply, "i int, v array<double>")
    found = sent.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(k)]).collect()
    out = np.zeros((d, k))
    for row in found:
        out[row["i"]] = row[1:]
    return out


def fit_projection(df: DataFrame, features: Sequence[str], k: int, seed: int = 42) -> Projection:
    """The k largest components of the standardized columns; missing values count as the mean."""
    measures = {"n": ("count({c})", "bigint"), "mean": ("avg({c})", "double"), "spread": ("stddev_samp({c})", "double")}
    clean = df.select(*[F.nanvl(col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in features])
    found = {r.column_name: r for r in per_column(clean, features, measures).collect()}
    mean = np.array([found[c].mean or 0.0 for c in features])
    spread = np.array([found[c].spread or 1.0 for c in features])
    varied = sum(1 for c in features if found[c].spread)
    k = min(k, varied)
    rows = df.select(F.array(*[F.coalesce(col(c).cast("double"), F.lit(float("nan"))) for c in features]).alias("x"))
    width = min(len(features), k + EXTRA)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(features), width)))[0]
    for _ in range(PASSES if k else 0):
        q = np.linalg.qr(_products(rows, mean, spread, q))[0]
    inner = q.T @ _products(rows, mean, spread, q) if k else np.zeros((0, 0))
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-values)[:k]
    directions = (q @ vectors[:, order]).T if k else np.zeros((0, len(features)))
    for row in directions:
        if row[np.argmax(np.abs(row))] < 0:
            row *= -1
    total = sum((found[c].n - 1) for c in features if found[c].spread)
    return Projection(tuple(features), mean, spread, directions, tuple(float(v / total) for v in values[order]))


def project(df: DataFrame, fitted: Projection, keys: Sequence[str] = ()) -> DataFrame:
    """Keys and columns ``component_1`` to ``component_k`` of every row."""
    k = len(fitted.directions)
    held = F.struct(*[col(c) for c in keys]) if keys else F.struct(F.lit(0).alias("_"))
    rows = df.select(
        held.alias("keys"), F.array(*[F.coalesce(col(c).cast("double"), F.lit(float("nan"))) for c in fitted.features]).alias("x")
    )
    names = [f"component_{i + 1}" for i in range(k)]

    def run(batches):
        for batch in batches:
            out = _standardized(batch.column(1), fitted.mean, fitted.spread) @ fitted.directions.T
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(out[:, i]) for i in range(k)]], names=["keys", *names])

    schema = ", ".join([f"keys {rows.schema['keys'].dataType.simpleString()}", *[f"{n} double" for n in names]])
    return rows.mapInArrow(run, schema).select(*(["keys.*"] if keys else []), *names)
