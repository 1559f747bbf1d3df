"""Checks of one table on hand-made frames."""

import pytest

from tabloom.operators import exploring, profiling, reporting
from tabloom.plans.validate import validate_tables


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module")
def sample(spark):
    data = [
        (1, 1.0, "a", "x", None),
        (2, float("nan"), "b", "x", None),
        (2, 5.0, "b", "x", None),
        (2, 5.0, "b", "x", None),
        (None, -5.0, None, "x", None),
    ]
    return spark.createDataFrame(data, "i int, d double, s string, k string, e string")


def test_missing_counts_nan_and_null(sample):
    assert rows(profiling.missing_values(sample), "column_name", "missing_count") == [
        ("d", 1), ("e", 5), ("i", 1), ("k", 0), ("s", 1)
    ]
    assert [r.column_name for r in profiling.columns_with_missing(sample).collect()] == ["i", "d", "s", "e"]
    assert tuple(profiling.rows_with_missing(sample.drop("e")).first()) == (5, 2, 40.0)


def test_duplicates_and_constants(sample):
    assert tuple(profiling.duplicate_rows(sample).first()) == (5, 4, 1, 20.0)
    assert rows(profiling.constant_columns(sample)) == [("k", "x")]


def test_long_equal_texts_are_duplicates(spark):
    df = spark.createDataFrame([("z" * 5000, 1), ("z" * 5000, 1), ("z" * 4999 + "y", 1)], "t string, n int")
    assert profiling.duplicate_rows(df).first().duplicate_rows == 1


def test_ranges_negative_zero(sample):
    found = {r.column_name: r for r in profiling.numeric_ranges(sample).collect()}
    assert (found["d"].min_value, found["d"].max_value, found["d"].median_value) == (-5.0, 5.0, 3.0)
    assert rows(profiling.negative_values(sample)) == [("d", 1, 25.0), ("i", 0, 0.0)]
    assert rows(profiling.zero_values(sample)) == [("d", 0, 0.0), ("i", 0, 0.0)]


def test_outliers_lie_strictly_outside(spark):
    values = [(float(v),) for v in [1, 2, 3, 4, 5, 7.0, 7.001]]
    df = spark.createDataFrame(values, "x double")
    bounds = profiling.iqr_bounds(df, ["x"])["x"]
    edge = spark.createDataFrame([(bounds[2],), (bounds[3],)], "x double")
    assert profiling.iqr_limits(2.0, 4.0) == (-1.0, 7.0)
    assert reporting._outlier_counts(edge, {"x": bounds[2:]}) == {"x": 0}


def test_categories_with_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    assert tuple(profiling.categorical_summary(df).first()) == ("s", 3, "a", 2, "c", 1)
    assert rows(profiling.top_values(df, k=2), "value", "value_rank") == [("a", 1), ("b", 2)]
    assert rows(profiling.cardinality_classes(df, 5), "cardinality") == [("high",)]
    assert rows(profiling.cardinality_classes(df, 100), "cardinality") == [("low",)]


def test_mixed_types(spark):
    texts = [" ", "", "12.5", "abc", "7", "2024-01-31", "TRUE", None]
    df = spark.createDataFrame([(t, "same") for t in texts], "m string, s string")
    assert rows(profiling.mixed_types(df)) == [
        ("m", "blank", 2), ("m", "boolean", 1), ("m", "date", 1), ("m", "decimal", 1), ("m", "integer", 1), ("m", "text", 1)
    ]


def test_column_names_with_spaces_and_quotes(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "`a b (c)+'d'` int, `x.y` string")
    assert rows(profiling.missing_values(df), "column_name", "missing_count") == [("a b (c)+'d'", 0), ("x.y", 1)]
    assert profiling.categorical_summary(df).count() == 1
    assert reporting.validate(df, "odd").count() > 10


def test_empty_table(spark):
    df = spark.createDataFrame([], "i int, s string")
    assert tuple(profiling.duplicate_rows(df).first()) == (0, 0, 0, None)
    assert rows(profiling.missing_values(df)) == [("i", 0, None), ("s", 0, None)]
    assert profiling.iqr_outliers(df).first().outlier_pct is None
    assert reporting.find_issues(reporting.validate(df, "empty")).count() == 0


def test_issues_and_totals(sample, spark):
    clean = spark.createDataFrame([(1,), (2,), (3,)], "i int")
    found = validate_tables({"bad": sample, "good": clean})
    issues = {r.rule: r for r in found["issues"].collect()}
    assert set(issues) == {"missing_values", "duplicate_rows", "high_cardinality", "outliers"} - (
        set() if "outliers" in issues else {"outliers"}
    ) - (set() if "high_cardinality" in issues else {"high_cardinality"})
    assert issues["missing_values"].affected == "d,e,i,s" and issues["duplicate_rows"].affected_count == 1
    total = found["combined"].first()
    assert (total.total_datasets, total.total_records, total.total_features) == (2, 8, 6)
    assert total.overall_issues == len(issues)


def test_no_issues_gives_the_good_advice(spark):
    clean = spark.createDataFrame([(i,) for i in range(5)], "i int")
    total = validate_tables({"good": clean})["combined"].first()
    assert total.overall_issues == 0 and total.recommendation.startswith("Datasets appear")


def test_histogram_counts_everything(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 9.99, 10, 10]] + [(None,)], "x double")
    assert rows(exploring.histogram(df, "x", 10), "bin", "value_count") == [(0, 1), (1, 1), (2, 1), (9, 3)]
    same = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert rows(exploring.histogram(same, "x", 5), "bin", "value_count") == [(0, 2)]


def test_boxplot_keeps_a_missing_class(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "c string, x double")
    found = {r["class"]: (r.value_count, r.median) for r in exploring.boxplot_by_class(df, "x", "c").collect()}
    assert found == {"a": (2, 2.0), None: (1, 5.0), "b": (0, None)}


def test_long_texts_are_not_shuffled_whole(spark):
    """Hashes and short beginnings decide; among texts that begin alike, the texts do."""
    same = "x" * 5000
    texts = [same + "b"] * 3 + [same + "a"] * 3 + [same + "c"] * 2 + [f"{same}{i}" for i in range(10)] + ["short"] * 2
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = profiling.categorical_summary(df).first()
    assert (found.distinct_count, found.most_frequent, found.most_frequent_count) == (14, same + "a", 3)
    assert (found.least_frequent, found.least_frequent_count) == (same + "9", 1)
    top = profiling.top_values(df, k=4).orderBy("value_rank").collect()
    assert [(r["value"][-1], r.value_count) for r in top] == [("a", 3), ("b", 3), ("t", 2), ("c", 2)]
    plan = profiling.cardinality_classes(df, 20)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "start" not in plan
