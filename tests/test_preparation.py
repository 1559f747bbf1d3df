"""Cleaning, encoding, features and scaling."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions import joins as joins_module
from tabloom.operators import cleaning, encoding, exploring, features, profiling, reporting, scaling, splitting
from tabloom.plans.prepare import apply_preparation, prepare
from tabloom.plans.transform import transform


def column(df, name):
    return [r[0] for r in df.select(F.col(f"`{name}`")).collect()]


def test_coerce_numeric(spark):
    texts = [" ", "", "12.5", "abc", "-3", " 4 ", "1e3", "5d", "0x1", None, ".5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert column(cleaning.coerce_numeric(df, ["t"]), "t") == [
        None, None, 12.5, None, -3.0, 4.0, 1000.0, None, None, None, 0.5
    ]


def test_yes_no_columns_must_be_complete(spark):
    df = spark.createDataFrame([("yes", "yes", "No"), ("Yes", None, "maybe"), ("no", "No", "No")], "a string, b string, c string")
    assert cleaning.fit_yes_no(df) == ["a"]
    assert cleaning.scan_facts(df).yes_no == ["a"]
    assert column(cleaning.standardize_yes_no(df, ["a"]), "a") == ["Yes", "Yes", "No"]


def test_fill(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "b", None), (None, float("nan"), "a", None), (4, 3.0, "b", None), (2, 8.0, "a", None), (None, 5.0, None, None)],
        "i int, d double, s string, e string",
    )
    fill = cleaning.fit_fill(df)
    assert fill.medians == {"i": 2.0, "d": 4.0}
    assert fill.modes == {"s": "a", "e": "Unknown"}
    out = cleaning.fill_missing(df, fill)
    assert column(out, "i") == [1.0, 2.0, 4.0, 2.0, 2.0] and column(out, "d") == [1.0, 4.0, 3.0, 8.0, 5.0]
    assert column(out, "s")[-1] == "a" and set(column(out, "e")) == {"Unknown"}


def test_complete_columns_keep_their_type(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    assert cleaning.fill_missing(df, cleaning.fit_fill(df)).dtypes == df.dtypes


def test_caps(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    caps = cleaning.fit_caps(df)
    assert caps == {"x": (-1.0, 7.0)}
    once = cleaning.cap_outliers(df, caps)
    assert column(once, "x") == [1.0, 2.0, 3.0, 4.0, 7.0, None]
    assert column(cleaning.cap_outliers(once, caps), "x") == column(once, "x")
    assert tuple(cleaning.capped_counts(df, caps).first()) == ("x", 1, -1.0, 7.0)
    with pytest.raises(ValueError):
        cleaning.fit_caps(df, method="other")


def test_duplicates_are_dropped_once(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "i int, s string")
    once = cleaning.drop_duplicates(df)
    assert once.count() == 2 == cleaning.drop_duplicates(once).count()


def test_routing_at_the_limit(spark):
    df = spark.range(400).select(
        (F.col("id") % 50).cast("string").alias("fifty"), (F.col("id") % 51).cast("string").alias("more")
    )
    assert set(encoding.fit_categories(df, ["fifty", "more"])) == {"fifty"}
    routes = {r.column_name: (r.distinct_count, r.encoding) for r in encoding.route_cardinality(df).collect()}
    assert routes == {"fifty": (50, "one_hot"), "more": (51, "label")}


def test_one_hot_drops_the_first(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, None)], "i int, s string")
    out = encoding.encode_one_hot(df, encoding.fit_categories(df, ["s"]))
    assert out.columns == ["i", "s_b", "s_c"] == ["i", *encoding.one_hot_names("s", "bca")]
    assert sorted(map(tuple, out.collect())) == [(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 0, 0)]


def _words(spark):
    # a third of the rows hold one value, some hold none
    word = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(
        F.concat(F.lit("w"), F.col("id") % 700)
    )
    return spark.range(6000).select("id", word.alias("w"))


@pytest.mark.parametrize("small", [True, False])
def test_labels_are_ranks(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(joins_module, "SMALL", 0)
    df = _words(spark)
    out = encoding.encode_label(df, "w", encoding.label_dictionary(df, "w"))
    words = {r.id: r.w for r in df.collect()}
    codes = {w: i for i, w in enumerate(sorted({w for w in words.values() if w is not None}))}
    assert {r.id: r.w for r in out.collect()} == {i: codes.get(w) for i, w in words.items()}


@pytest.mark.parametrize("long", [False, True])
def test_hot_values_do_not_reach_the_shuffled_join(spark, monkeypatch, long):
    """The rows of the shuffled branch hold no value, null or text, more often than its share."""
    monkeypatch.setattr(joins_module, "SMALL", 0)
    df = _words(spark).select((F.concat(F.col("w"), F.lit("x" * 9000)) if long else F.col("w")).alias("w"))
    shuffled = []
    join = type(df).join

    def watched(self, other, on=None, how=None):
        if how == "left":
            shuffled.append(self)
        return join(self, other, on, how)

    monkeypatch.setattr(type(df), "join", watched)
    looked_up = encoding._lookup(df, "w", encoding.label_dictionary(df, "w"), "code")
    assert looked_up.count() == 6000 and looked_up.where("_found IS NULL").count() == looked_up.where("w IS NULL").count()
    assert len(shuffled) == 1
    assert shuffled[0].groupBy("_key").count().agg(F.max("count")).first()[0] <= 6000 / joins_module.HOT_SHARE + 1


def test_target_means(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 0)], "c string, y int")
    means = encoding.fit_target_means(df, "c", "y", weight=2.0)
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    assert column(encoding.encode_target(new, "c", means), "c") == pytest.approx([0.5, 2 / 3, 0.5, 0.5])


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([(1,)], "other int")
    assert features.add_features(df).columns == ["other"]
    charges = spark.createDataFrame([(10.0, 20.0)], "MonthlyCharges double, TotalCharges double")
    assert "avg_monthly_charges" not in features.add_financial_features(charges).columns


def test_services_strict(spark):
    names = ["PhoneService", "MultipleLines_No phone service", "StreamingTV_Yes", "StreamingTV_No internet service"]
    assert features.service_columns(names) == names
    assert features.service_columns(names, strict=True) == ["PhoneService", "StreamingTV_Yes"]
    df = spark.createDataFrame([(1, 1, None, 1)], ", ".join(f"`{n}` int" for n in names))
    row = features.add_service_features(df).first()
    assert (row.total_services, row.has_premium_services) == (3, 1)


def test_feature_groups_and_target(spark):
    df = spark.createDataFrame([("k", 5, 1.0, 2.0)], "customerID string, tenure int, MonthlyCharges double, TotalCharges double")
    groups = features.feature_groups(df)
    assert groups.where("feature_group = 'tenure_features'").count() == 8
    table, labels = features.split_features_labels(features.add_features(df), "customerID")
    assert labels.columns == ["customerID", "Churn"] and labels.first().Churn == 0
    assert "Churn" not in table.columns


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0), (10.0, 7.0)], "x double, same double")
    standard = column(scaling.scale(df, scaling.fit_scaling(df, ["x", "same"])), "x")
    assert sum(standard) == pytest.approx(0) and sum(v * v for v in standard) / 4 == pytest.approx(1)
    for method in scaling.METHODS:
        assert column(scaling.scale(df, scaling.fit_scaling(df, ["same"], method)), "same") == [0.0] * 4
    assert column(scaling.scale(df, scaling.fit_scaling(df, ["x"], "minmax")), "x")[-1] == 1.0
    assert column(scaling.scale(df, scaling.fit_scaling(df, ["x"], "robust")), "x")[1] == pytest.approx(-0.5 / 3.0)
    with pytest.raises(ValueError):
        scaling.fit_scaling(df, ["x"], "other")


def test_anova_and_selection(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 5.0, 0.0, 0), (2, 2.0, 5.0, 0.0, 0), (3, 8.0, 5.0, 1.0, 1), (4, 9.0, 5.0, 1.0, 1)],
        "id int, far double, same double, perfect double, y int",
    )
    scores = {r.column_name: r.f_score for r in scaling.anova_scores(df, "y", ["far", "same", "perfect"]).collect()}
    assert scores["far"] == pytest.approx(98.0) and scores["same"] is None and scores["perfect"] == math.inf
    assert scaling.select_k_best(df, "y", 2, ["id"]).columns == ["id", "far", "perfect", "y"]
    assert scaling.select_k_best(df, "y", 9, ["id"]).columns == ["id", "far", "same", "perfect", "y"]
    assert scaling.select_k_best(df, "nothing", 1) is df


def test_later_column_wins_a_tie():
    scores = {"a": 1.0, "b": 2.0, "c": 1.0 + 1e-13, "d": None, "e": 1.0}
    assert scaling.best_columns(scores, 2) == ["b", "e"]
    assert scaling.best_columns(scores, 4) == ["a", "b", "c", "e"]


def test_learned_on_other_rows(spark):
    train = spark.createDataFrame([(str(i), float(i), "ab"[i % 2]) for i in range(20)], "customerID string, x double, c string")
    new = spark.createDataFrame([("n1", 1000.0, "b"), ("n2", None, "never seen")], "customerID string, x double, c string")
    prepared, learned = prepare(new, fit_on=train)
    rows = {r.customerID: r for r in prepared.collect()}
    assert rows["n1"].x == learned.caps["x"][1] and rows["n1"].c_b == 1 and rows["n2"].c_b == 0
    assert sorted(map(tuple, apply_preparation(new, learned).collect()), key=str) == sorted(
        map(tuple, prepared.collect()), key=str
    )


def test_whole_preparation_ignores_row_order(spark):
    df = spark.createDataFrame(
        [
            (f"c{i}", i % 2, i % 73, 20.0 + i, " " if i % 73 == 0 else str(i * 3.5), "YN"[i % 2], ["yes", "No"][i % 2])
            for i in range(150)
        ]
        * 2,
        "customerID string, SeniorCitizen int, tenure int, MonthlyCharges double, TotalCharges string, g string, Churn string",
    )
    one = transform(prepare(df)[0])
    other = transform(prepare(df.repartition(7).orderBy(F.desc("customerID")))[0])
    assert one.columns == other.columns and one.count() == 150
    assert one.exceptAll(other).count() == 0
    assert one.where("Churn NOT IN (0, 1)").count() == 0
    flags = [c for c in one.columns if c.startswith("tenure_") and c.endswith(("year", "years")) and c != "tenure_years"]
    assert one.where(" + ".join(f"`{c}`" for c in flags) + " > 1").count() == 0


def test_categories_up_to_any_limit(spark):
    df = spark.range(4000).selectExpr("concat('v', id % 2000) AS c", "concat('w', id) AS d")
    found = encoding.fit_categories(df, ["c", "d"], limit=2500)
    assert len(found["c"]) == 2000 and "d" not in found
    assert encoding.fit_categories(df, ["c", "d"]) == {}


def test_classes_may_be_many(spark):
    df = spark.range(3000).selectExpr("id", "id % 301 AS c", "CAST(id AS double) AS v")
    assert splitting.class_weights(df, "c").count() == 301
    weighted = splitting.with_class_weight(df, "c")
    assert weighted.count() == 3000 and weighted.where("class_weight IS NULL").count() == 0
    marked = splitting.stratified_split(df, ["id"], "c")
    tests = marked.groupBy("c").agg({"split": "count"}).count(), marked.where("split = 'test'").count()
    assert tests == (301, 602)  # two of each ten, or nine, rows
    boxes = exploring.boxplot_by_class(df, "v", "c").collect()
    assert len(boxes) == 301 and all(b["min_value"] <= b["q1"] <= b["median"] <= b["q3"] <= b["max_value"] for b in boxes)


def test_labels_of_long_and_frequent_texts(spark):
    long = "x" * 10_000
    df = spark.createDataFrame([(long,)] * 50 + [(None,)] * 50 + [(f"v{i}",) for i in range(60)], "t string")
    dictionary = encoding.label_dictionary(df, "t")
    coded = encoding.encode_label(df, "t", dictionary)
    assert coded.where("t IS NULL").count() == 50
    assert coded.groupBy("t").count().where("count = 50 AND t IS NOT NULL").count() == 1
    joins_module.SMALL, small = 0, joins_module.SMALL
    try:  # the way for dictionaries too large to broadcast gives the same
        assert sorted(map(str, encoding.encode_label(df, "t", dictionary).collect())) == sorted(map(str, coded.collect()))
    finally:
        joins_module.SMALL = small


def test_oversampling_evens_classes(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END AS c")
    sizes = {r["c"]: r["count"] for r in splitting.oversample(df, "c", ["id"]).groupBy("c").count().collect()}
    assert sizes[0] == 2700 and abs(sizes[1] - 2700) < 60


def test_tables_with_maps_are_profiled(spark):
    df = spark.sql("SELECT map('a', 1) AS m, CAST('NaN' AS double) AS x UNION ALL SELECT map('a', 1), NULL")
    assert [r["column_name"] for r in profiling.constant_columns(df).collect()] == ["m"]
    assert profiling.duplicate_rows(df).first()["duplicate_rows"] == 1
    assert reporting.validate(df, "maps").count() > 0


def test_scaling_leaves_group_flags_alone(spark):
    rows = [(f"k{i}", float(i), 10.0 * i, 100.0 * i, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "customerID string, tenure double, MonthlyCharges double, TotalCharges double, Churn int")
    scaled = transform(df, scaling="standard")
    flags = features.bin_flag_columns(scaled.columns)
    assert len(flags) == 13
    assert {v for f in flags for v in column(scaled, f)} == {0, 1}
    assert column(scaled, "tenure") != column(df, "tenure")
    assert {v for f in flags for v in column(transform(df, scaling="standard", scale_bins=True), f)} - {0, 1}


def test_correlation_of_many_columns_with_gaps(spark):
    rng = np.random.default_rng(9)
    data = rng.normal(size=(500, 60)) + 1e6
    data[:, 5] = 3.0
    data[rng.random(data.shape) < 0.1] = np.nan
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"x{i} double" for i in range(60)))
    got = {(r.column_a, r.column_b): r.correlation for r in exploring.correlation(df.repartition(6)).collect()}
    assert len(got) == 3600 and got["x5", "x1"] is None
    for i, j in ((0, 1), (3, 59), (7, 7), (40, 2)):
        both = ~np.isnan(data[:, i]) & ~np.isnan(data[:, j])
        assert got[f"x{i}", f"x{j}"] == pytest.approx(np.corrcoef(data[both, i], data[both, j])[0, 1], abs=1e-6)
