"""Target means that no row had a part in."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import encoding
from tabloom.operators.evaluation import roc_auc

SCHEMA = "k long, c string, y int, fold int"


def plain(rows, weight=None):
    """Encoded values by key, from all rows of other folds, one by one."""
    out = {}
    for k, c, _, fold in rows:
        others = [(v, y) for _, v, y, f in rows if f != fold and y is not None]
        overall = sum(y for _, y in others) / len(others)
        groups = {}
        for v, y in others:
            if v is not None:
                groups.setdefault(v, []).append(y)
        pull = weight
        if weight is None:
            n, p = sum(map(len, groups.values())), np.mean([y for g in groups.values() for y in g])
            chance = p * (1 - p)
            beyond = sum(len(g) * (np.mean(g) - p) ** 2 for g in groups.values()) - (len(groups) - 1) * chance
            scale = n - sum(len(g) ** 2 for g in groups.values()) / n
            pull = chance / (beyond / scale) if beyond > 0 and scale else np.inf
        own = groups.get(c)
        out[k] = overall if own is None or pull == np.inf else (sum(own) + overall * pull) / (len(own) + pull)
    return out


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(3)
    rates = {"a": 0.1, "b": 0.8, "c": 0.5, "rare": 1.0, None: 0.4}
    names = list(rates)
    out = []
    for k in range(600):
        c = names[int(random.choice(5, p=[0.5, 0.2, 0.2, 0.02, 0.08]))]
        out.append((k, c, None if k % 50 == 0 else int(random.random() < rates[c]), int(random.integers(0, 4))))
    return [*out, (900, "alone", 1, 2)]


@pytest.mark.parametrize("weight", [None, 10.0, 0.0])
def test_against_all_other_folds(spark, rows, weight):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = encoding.encode_target_out_of_fold(df, "c", "y", "fold", weight)
    assert found.columns == df.columns
    got, want = {r.k: r.c for r in found.collect()}, plain(rows, weight)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_frequent_categories_are_not_shuffled(spark, rows, monkeypatch):
    from tabloom.functions import joins

    monkeypatch.setattr(joins, "SMALL", 2)
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = {r.k: r.c for r in encoding.encode_target_out_of_fold(df, "c", "y", "fold").collect()}, plain(rows)
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_noise_gains_nothing(spark):
    """A category of a few rows tells its own targets in sample, and nothing out of fold."""
    random = np.random.default_rng(9)
    noise = [(k, f"c{random.integers(0, 500)}", int(random.random() < 0.5), k % 5) for k in range(3000)]
    df = spark.createDataFrame(noise, SCHEMA)
    area = lambda frame: roc_auc(frame, "y", "c").first().roc_auc
    in_sample = encoding.encode_target(df, "c", encoding.fit_target_means(df, "c", "y"))
    assert area(in_sample) > 0.65
    assert abs(area(encoding.encode_target_out_of_fold(df, "c", "y", "fold")) - 0.5) < 0.04
    told = spark.createDataFrame([(k, c, int((zlib.crc32(c.encode()) % 2) ^ (random.random() < 0.1)), f) for k, c, _, f in noise], SCHEMA)
    assert area(encoding.encode_target_out_of_fold(told, "c", "y", "fold")) > 0.8


def test_own_target_has_no_part(spark, rows):
    """Turning all targets of a fold around changes nothing for the rows of that fold."""
    df = spark.createDataFrame(rows, SCHEMA)
    turned = df.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    one, two = ({r.k: r.c for r in encoding.encode_target_out_of_fold(d, "c", "y", "fold").where("fold = 1").collect()} for d in (df, turned))
    assert one == two


def test_empty_and_single_folds(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert encoding.encode_target_out_of_fold(empty, "c", "y", "fold").count() == 0
    one = spark.createDataFrame([(1, "a", 1, 0), (2, "a", 0, 0)], SCHEMA)
    assert {r.c for r in encoding.encode_target_out_of_fold(one, "c", "y", "fold").collect()} == {None}  # there are no other folds
