"""Days that are measured one by one against all rows at once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions.columns import nan_to_null
from tabloom.operators import states
from tabloom.operators.reporting import find_issues, validate
from tabloom.sources.commits import Conflict

SKETCHED = {"median_value", "lower_bound", "upper_bound", "outlier_count", "outlier_pct"}
SCHEMA = "day string, n bigint, x double, s string, one string, flag boolean, m map<string,int>"


def report(frame):
    return {(r.check, r.column_name, r.metric): r.value for r in frame.collect()}


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(1)
    rows = []
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"):
        for i in range(300 if day != "2024-01-03" else 7):
            x = float(random.normal() * 10 + 1e6)
            rows.append((day, int(random.integers(-5, 5)), [x, math.nan, None, 0.0, -0.0][int(random.choice(5, p=[0.9, 0.03, 0.03, 0.02, 0.02]))],
                         str(random.choice(["a", "b", "c", "z" * 500])) if i % 9 else None, "same", None if i % 2 else True, {"k": i % 3}))
    rows += rows[:40]  # copies within a day
    rows += [("2024-01-02", *r[1:]) for r in rows[:25]]  # and over days
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def root(table, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("states"))
    for day in sorted(r.day for r in table.select("day").distinct().collect()):
        states.add_day(table.where(F.col("day") == day).drop("day"), folder, day)
    return folder


def test_days_equal_the_whole(spark, table, root):
    whole, merged = report(validate(table.drop("day"), "t")), report(states.merged(spark, root, "t"))
    assert set(whole) == set(merged)
    for key, value in whole.items():
        if key[2] not in SKETCHED:
            assert merged[key] == pytest.approx(value, rel=1e-9, abs=1e-9), key


def test_sketched_values_are_within_the_rank_error(spark, table, root):
    merged = report(states.merged(spark, root, "t"))
    for c in ("n", "x"):
        values = np.array([r[0] for r in table.select(c).where(f"{c} IS NOT NULL AND NOT isnan({c})").collect()], float)
        middle = merged["ranges", c, "median_value"]
        low, high = np.mean(values < middle), np.mean(values <= middle)
        assert low - states.RANK_ERROR <= 0.5 <= high + states.RANK_ERROR + 1 / len(values)
        bounds = [merged["outliers", c, b] for b in ("lower_bound", "upper_bound")]
        outside = np.sum((values < bounds[0]) | (values > bounds[1]))
        assert abs(merged["outliers", c, "outlier_count"] - outside) <= 2 * states.RANK_ERROR * len(values) + 1


def test_rank_error_of_many_merged_sketches(spark):
    rows = spark.range(200_000).select((F.xxhash64("id") % 100_000).cast("double").alias("x"), (F.col("id") % 50).alias("day"))
    sketches = rows.groupBy("day").agg(F.expr(f"kll_sketch_agg_double(x, {states.SKETCH})").alias("k"))
    points = [i / 20 for i in range(1, 20)]
    wanted = ", ".join(f"{p}D" for p in points)
    found = sketches.agg(F.expr("kll_merge_agg_double(k)").alias("k")).select(F.expr(f"kll_sketch_get_quantile_double(k, array({wanted}))")).first()[0]
    ranks = rows.agg(*[F.avg((F.col("x") <= v).cast("double")) for v in found]).first()
    assert max(abs(r - p) for r, p in zip(ranks, points)) <= states.RANK_ERROR


def test_old_days_are_not_read(spark, table, root, tmp_path):
    """Only states are: the rows of earlier days may be gone."""
    source, folder = tmp_path / "rows", str(tmp_path / "states")
    for day in ("2024-01-01", "2024-01-02"):
        table.where(F.col("day") == day).drop("day").write.parquet(str(source / day))
        rows = spark.read.parquet(str(source / day))
        states.add_day(rows, folder, day)
        for part in (source / day).iterdir():
            part.unlink()
    both = table.where("day <= '2024-01-02'").drop("day")
    assert report(states.merged(spark, folder, "t"))["shape", "", "row_count"] == both.count()


def test_a_day_again_replaces_it(spark, table, tmp_path):
    folder = str(tmp_path)
    first = table.where("day = '2024-01-01'").drop("day")
    states.add_day(first.limit(10), folder, "a")
    states.add_day(first, folder, "b")
    assert states.add_day(first, folder, "a") == 3
    found = report(states.merged(spark, folder, "t"))
    assert found["shape", "", "row_count"] == 2 * first.count()
    assert found["duplicates", "", "distinct_rows"] == nan_to_null(first).withColumn("m", F.to_json("m")).distinct().count()
    assert report(states.merged(spark, folder, "t", ["b"]))["shape", "", "row_count"] == first.count()
    assert states.drop_replaced(spark, folder) == 1
    assert report(states.merged(spark, folder, "t")) == found
    log = states._log(spark, folder)
    with pytest.raises(Conflict):
        log.append([{"day": "a", "folder": "x", "column_count": 1, "exact": True}], 2, ["day"])


def test_without_hashes(spark, table, tmp_path):
    folder = str(tmp_path)
    for day in ("2024-01-01", "2024-01-02"):
        states.add_day(table.where(F.col("day") == day).drop("day"), folder, day, exact=False)
    found = report(states.merged(spark, folder, "t"))
    assert found["categories", "s", "distinct_count"] == 4 and ("duplicates", "", "duplicate_rows") not in found


def test_empty_days_and_issues(spark, table, tmp_path):
    folder, rows = str(tmp_path), table.drop("day")
    states.add_day(rows.limit(0), folder, "none")
    empty = report(states.merged(spark, folder, "t"))
    assert empty["shape", "", "row_count"] == 0 and empty["ranges", "x", "median_value"] is None
    states.add_day(rows, folder, "all")
    mine, plain = (find_issues(m) for m in (states.merged(spark, folder, "t"), validate(rows, "t")))
    assert {(r.rule, r.affected) for r in mine.collect()} == {(r.rule, r.affected) for r in plain.collect()}
    with pytest.raises(FileNotFoundError):
        states.merged(spark, str(tmp_path / "nothing"), "t")
