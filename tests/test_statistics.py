"""Exact quantiles, running totals and row expressions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions import quantiles as Q
from tabloom.functions.expressions import bin_flags, bin_label, clip, ratio, recoded, row_sum
from tabloom.functions import joins
from tabloom.functions.ordering import with_running_totals

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, **columns):
    rows = list(zip(*[[None if v is None else float(v) for v in c] for c in columns.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in columns)).repartition(5)


@pytest.fixture
def narrow(monkeypatch):
    """Small limits, so that a small table goes through every step of the search."""
    monkeypatch.setattr(Q, "GATHER_ROWS", 40)
    monkeypatch.setattr(Q, "ACCURACY", 50)
    monkeypatch.setattr(Q, "GRID", 10)


def test_narrowing_equals_numpy(spark, narrow):
    rng = np.random.default_rng(7)
    n = 4000
    columns = {
        "uniform": rng.random(n),
        "heavy": np.where(rng.random(n) < 0.35, 5.0, rng.normal(5, 3, n)),
        "few": rng.integers(0, 3, n),
        "wide": rng.standard_cauchy(n) * 1e12,
        "same": np.full(n, -2.5),
    }
    found = Q.column_quantiles(frame(spark, **columns), list(columns), PROBS)
    for name, values in columns.items():
        np.testing.assert_allclose(found[name], np.quantile(values.astype(float), PROBS), rtol=1e-12)


def test_rank_just_beside_a_hot_value(spark, narrow):
    values = [1.0] * 3 + [7.0] * 2000 + [8.0, 9.0] + list(range(100, 600))
    df = frame(spark, x=values)
    ordered = sorted(values)
    for rank in (2, 3, 2002, 2003, 2004, 2005, 2504):
        assert Q.ranked_values(df, {"x": F.col("x")}, {"x": rank}) == {"x": ordered[rank]}


def test_wrong_guess_is_corrected(spark, narrow):
    df = frame(spark, x=range(1000))
    for guess in ((1000, -50.0, -20.0), (1000, 2000.0, 3000.0), (1000, 990.0, 995.0), (1000, 500.0, 500.0)):
        assert Q.ranked_values(df, {"x": F.col("x")}, {"x": 421}, {"x": guess}) == {"x": 421.0}


def test_missing_values_do_not_count(spark):
    df = frame(spark, x=[None, 3, 1, None, 2, float("nan"), 10], empty=[None] * 7)
    assert Q.column_quantiles(df, ["x", "empty"], [0.25, 0.5]) == {"x": [1.75, 2.5], "empty": [None, None]}


@pytest.mark.parametrize("n", [1_000, 150_000])
def test_infinities_at_any_size(spark, n):
    """The same shares of infinities give the same answer in a small and in a large table."""
    inf = "CAST('Infinity' AS double)"
    df = spark.range(n).selectExpr(
        f"CASE WHEN id % 10 = 0 THEN {inf} WHEN id % 10 = 1 THEN -{inf} ELSE id % 10 END AS x", "id % 10 AS plain"
    )
    found = Q.column_quantiles(df, ["x", "plain"], [0.0, 0.05, 0.5, 0.95, 1.0])
    assert found["x"] == [float("-inf"), float("-inf"), 5.5, float("inf"), float("inf")]
    assert found["plain"] == [0.0, 0.0, 4.5, 9.0, 9.0]


def test_quantiles_of_many_groups(spark):
    """More than 200 groups, one of them large, one with ties, one infinite, one without values."""
    rng = np.random.default_rng(3)
    rows = [(f"g{i % 300}", float(v)) for i, v in enumerate(rng.integers(0, 50, 6000))]
    rows += [("hot", float(v)) for v in rng.random(5000)] + [("inf", float("inf")), ("inf", 1.0), ("none", None), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    found = Q.grouped_quantiles(df, F.col("g"), F.col("v"), {"a": 0.25, "b": 0.5, "c": 1.0}).collect()
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    got = {r["key"]: (r["a"], r["b"], r["c"]) for r in found}
    keys = {g: spark.range(1).select(Q.group_key(F.lit(g))).first()[0] for g in (None, "hot", "inf", "g7")}
    assert len(got) == len(by)
    for g in (None, "hot", "g7"):
        np.testing.assert_allclose(got[keys[g]], np.quantile(by[g], [0.25, 0.5, 1.0]))
    assert got[keys["inf"]] == (float("inf"), float("inf"), float("inf"))


def test_frequent_keys_are_not_shuffled(spark):
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 5 = 0 THEN NULL ELSE cast(id % 3000 AS string) END AS k", "id")
    groups = rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    for how in ("left", "inner"):
        got = joins.attach(rows, groups, "k", "n", how)
        want = rows.join(groups, "k", how)
        assert sorted(map(str, got.select("k", "id", "n", "top").collect())) == sorted(
            map(str, want.select("k", "id", "n", "top").collect())
        )
    hot = groups.where(F.col("n") > 20)
    assert [r["k"] for r in hot.collect()] == ["hot"]


def test_running_totals_over_many_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("k"), F.lit(2).alias("w")).repartition(16)
    out = with_running_totals(df, ["k"], {"before": F.col("w")})
    assert out.where("before <> 2 * k").count() == 0
    assert out.count() == 5000


def test_running_totals_of_nothing(spark):
    out = with_running_totals(spark.range(0), ["id"], {"before": F.lit(1)})
    assert out.columns == ["id", "before"] and out.count() == 0


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_ratio(spark):
    cases = [(6, 3, 2.0), (5, 0, 0.0), (-5, 0, 0.0), (0, 0, None), (None, 0, None), (None, 2, None), (1, None, None)]
    for n, d, expected in cases:
        assert one(spark, ratio(F.lit(n).cast("int"), F.lit(d).cast("double"))) == (expected,)


def test_bins_are_closed_on_the_right(spark):
    edges, labels = [0, 12, 24, 48, 72], ["a", "b", "c", "d", "e"]
    expected = {0: None, 0.5: "a", 12: "a", 12.5: "b", 24: "b", 48: "c", 72: "d", 73: "e", -1: None, None: None}
    for value, label in expected.items():
        v = F.lit(value).cast("double")
        assert one(spark, bin_label(v, edges, labels)) == (label,)
        assert one(spark, *bin_flags(v, edges, labels, "x")) == tuple(int(x == label) for x in labels)


def test_clip_keeps_missing(spark):
    assert one(spark, clip(F.lit(None).cast("double"), 1, 2), clip(F.lit(0), 1, 2), clip(F.lit(3), 1, 2)) == (None, 1.0, 2.0)
    assert one(spark, clip(F.lit(7), None, None)) == (7.0,)


def test_row_sum_and_recode(spark):
    assert one(spark, row_sum([F.lit(1), F.lit(None).cast("int"), F.lit(2)])) == (3,)
    assert one(spark, recoded(F.lit(1), {0: "No", 1: "Yes"}), recoded(F.lit(2), {0: "No", 1: "Yes"})) == ("Yes", None)
