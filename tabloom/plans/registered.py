"""Every operator as a query over the test tables.

Each function takes the session and a folder of Parquet tables and returns a
frame. Doubles are rounded to six digits, so that results of different engines
can be compared.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, numeric_columns
from ..functions.expressions import ratio
from ..operators import (
    cleaning,
    drift,
    encoding,
    evaluation,
    exploring,
    feature_store,
    features,
    kernel_machine,
    models,
    profiling,
    projection,
    reporting,
    scaling,
    splitting,
    states,
    synthetic,
    versioning,
)
from ..sources import files, raw_zone, snapshots
from ..sources.workspace import materialized, new_path, path_exists
from ..streaming import scoring
from . import train as training_plan
from .customer_profile import SCHEMA, customer_profile
from .prepare import KEY, prepare, prepare_all, typed
from .run import run
from .transform import feature_table, transform
from .validate import measure, validate_folder, validate_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LAST_DAY = "2024-01-31"
MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits by plain arithmetic, the same in every engine."""
    unit = float(10**digits)
    new = {
        f.name: (F.floor(col(f.name) * F.lit(unit) + F.lit(0.5)) / F.lit(unit)).alias(f.name)
        for f in df.schema
        if isinstance(f.dataType, T.DoubleType)
    }
    return df.select(*[new.get(c, col(c)) for c in df.columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LANDED: dict[tuple, str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, written by the first query that needs it in this application."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _LANDED or not path_exists(spark, _LANDED[slot]):
        path = new_path(spark, name)
        build().write.parquet(path)
        _LANDED[slot] = path
    return spark.read.parquet(_LANDED[slot])


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "customers", lambda: customer_profile(spark, sf_dir))


def prepared_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "prepared", lambda: prepare(customers(spark, sf_dir))[0])


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(prepared_customers(spark, sf_dir))


# --- sources and sinks ------------------------------------------------------


@query
def scan_csv_roundtrip(spark, sf_dir):
    path = files.write_csv(customers(spark, sf_dir), new_path(spark, "csv"))
    schema = spark.createDataFrame([], SCHEMA).schema
    return rounded(files.scan_csv(spark, path, schema))


@query
def ingest_sources(spark, sf_dir):
    root = new_path(spark, "ingest")
    sources = ["store_a", "store_b"]
    read = files.ingest(
        spark,
        {s: f"{root}/{s}" for s in sources},
        {s: lambda: customer_profile(spark, sf_dir) for s in sources},
    )
    rows = read["store_a"].withColumn("source", F.lit("store_a")).unionByName(
        read["store_b"].withColumn("source", F.lit("store_b"))
    )
    return rows.groupBy("source").agg(
        F.count("*").alias("row_count"),
        F.sum("tenure").alias("total_tenure"),
        F.min("customerID").alias("first_customer"),
        F.max("customerID").alias("last_customer"),
    )


def _land_events(spark, sf_dir, root):
    events = table(spark, sf_dir, "events")
    return raw_zone.store_raw(events, root, "events", F.col("event_type"), F.to_date("ts"))


_RAW_ROOTS: dict[tuple, str] = {}


def _raw_events(spark, sf_dir):
    """Root of a raw zone holding the events, by type and day."""
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _RAW_ROOTS or not path_exists(spark, _RAW_ROOTS[slot]):
        root = new_path(spark, "raw")
        _land_events(spark, sf_dir, root)
        _RAW_ROOTS[slot] = root
    return _RAW_ROOTS[slot]


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("ingest_date", F.col("ingest_date").cast("string"))


@query
def raw_zone_write(spark, sf_dir):
    written = _land_events(spark, sf_dir, new_path(spark, "raw"))
    # sizes depend on the writer: the result says that there are files, and bytes in them
    checked = written.withColumn("has_files", (F.col("file_count") > 0) & (F.col("size_mb") > 0))
    return _day(checked.drop("file_count", "size_mb"))


@query
def raw_zone_catalog(spark, sf_dir):
    listed = raw_zone.catalog(spark, _raw_events(spark, sf_dir), "events")
    named = F.col("file_path").rlike("/events/landing=[0-9a-f]+/source=") & F.col("file_path").endswith(".parquet")
    return _day(
        listed.groupBy("source", "ingest_date").agg(
            F.sum("row_count").alias("row_count"),
            F.every(named & (F.col("file_bytes") > 0)).alias("has_files"),
            (F.count("*") == F.count_distinct("file_path")).alias("files_are_distinct"),
        )
    )


@query
def raw_zone_retention(spark, sf_dir):
    listed = raw_zone.catalog(spark, _raw_events(spark, sf_dir), "events")
    report = raw_zone.retention(listed, LAST_DAY, 10)
    enough = (F.col("file_count") >= F.col("day_count")) & (F.col("size_mb") > 0)
    return report.withColumn("has_files", enough).drop("file_count", "size_mb")


@query
def raw_zone_expire(spark, sf_dir):
    """What is left, by source and day, after expired days were removed."""
    root = new_path(spark, "raw")
    _land_events(spark, sf_dir, root)
    raw_zone.drop_expired(spark, root, "events", LAST_DAY, 10)
    left = raw_zone.load_raw(spark, root, "events")
    return _day(left.groupBy("source", "ingest_date").agg(F.count("*").alias("row_count")))


@query
def raw_zone_relanded(spark, sf_dir):
    """All days; then those above 50 landed again, which replaces whole days; then old days dropped. With each day its commit."""
    root, events = new_path(spark, "raw"), table(spark, sf_dir, "events")
    for rows in (events, events.where("value > 50")):
        raw_zone.store_raw(rows, root, "events", F.col("event_type"), F.to_date("ts"))
    raw_zone.drop_expired(spark, root, "events", LAST_DAY, 10)
    raw_zone.drop_replaced(spark, root, "events")
    counted = raw_zone.load_raw(spark, root, "events").groupBy("source", "ingest_date").agg(F.count("*").alias("row_count"))
    commits = raw_zone.days(spark, root, "events").select("source", "ingest_date", F.col("number").alias("commit_number"))
    return _day(counted.join(commits, ["source", "ingest_date"]))


@query
def raw_zone_summary(spark, sf_dir):
    return raw_zone.summary(raw_zone.load_raw(spark, _raw_events(spark, sf_dir), "events"))


@query
def prepared_table_metadata(spark, sf_dir):
    log = snapshots.save_table(prepare(customers(spark, sf_dir))[0], new_path(spark, "snapshots"), "prepared")
    return log.select("table_name", "row_count", "column_count", "columns")


@query
def snapshot_fallback(spark, sf_dir):
    """Without a snapshot the first fallback that exists is read, with one the newest."""
    root, orders = new_path(spark, "snapshots"), table(spark, sf_dir, "orders")
    fallbacks = [new_path(spark, "absent"), f"{sf_dir}/orders.parquet"]
    before = snapshots.load_latest(spark, root, "orders", fallbacks)
    first = before.agg(F.lit("fallback").alias("found"), F.count("*").alias("row_count"), F.sum("o_orderkey").alias("total"))
    for day, status in ((1, "O"), (2, "F")):
        snapshots.save_table(orders.where(F.col("o_orderstatus") == status), root, "orders", dt.datetime(2024, 1, day))
    after = snapshots.load_latest(spark, root, "orders", fallbacks)
    return first.unionByName(
        after.agg(F.lit("newest").alias("found"), F.count("*").alias("row_count"), F.sum("o_orderkey").alias("total"))
    )


@query
def latest_snapshot(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    log = events.groupBy(
        F.col("event_type").alias("table_name"), F.to_date("ts").cast("string").alias("created_at")
    ).agg(F.count("*").alias("row_count"), F.count_distinct("user_id").alias("user_count"))
    return snapshots.latest(log)


# --- profiling --------------------------------------------------------------


@query
def profile_shape(spark, sf_dir):
    return profiling.shape(table(spark, sf_dir, "lineitem"), "lineitem")


@query
def profile_missing(spark, sf_dir):
    return rounded(profiling.missing_values(customers(spark, sf_dir)))


@query
def columns_with_missing(spark, sf_dir):
    return rounded(profiling.columns_with_missing(customers(spark, sf_dir)))


@query
def rows_with_missing(spark, sf_dir):
    return rounded(profiling.rows_with_missing(customers(spark, sf_dir)))


@query
def profile_mixed_types(spark, sf_dir):
    return profiling.mixed_types(customers(spark, sf_dir))


@query
def profile_duplicates(spark, sf_dir):
    return rounded(profiling.duplicate_rows(customers(spark, sf_dir)))


@query
def profile_duplicates_documents(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select("text", "lang")
    return rounded(profiling.duplicate_rows(texts))


@query
def constant_columns(spark, sf_dir):
    root = new_path(spark, "raw")
    raw_zone.store_raw(customers(spark, sf_dir), root, "customers", "store_a", LAST_DAY)
    return profiling.constant_columns(raw_zone.load_raw(spark, root, "customers"))


@query
def profile_numeric_ranges(spark, sf_dir):
    return rounded(profiling.numeric_ranges(table(spark, sf_dir, "lineitem")), 4)


@query
def profile_negative(spark, sf_dir):
    return rounded(profiling.negative_values(table(spark, sf_dir, "customer")))


@query
def profile_zero(spark, sf_dir):
    return rounded(profiling.zero_values(table(spark, sf_dir, "lineitem")))


@query
def profile_outliers_iqr(spark, sf_dir):
    return rounded(profiling.iqr_outliers(table(spark, sf_dir, "orders")))


@query
def profile_outliers_iqr_customers(spark, sf_dir):
    return rounded(profiling.iqr_outliers(customers(spark, sf_dir)))


@query
def profile_categorical(spark, sf_dir):
    return profiling.categorical_summary(customers(spark, sf_dir))


@query
def profile_top5(spark, sf_dir):
    return profiling.top_values(table(spark, sf_dir, "documents"))


@query
def profile_cardinality(spark, sf_dir):
    rows = customers(spark, sf_dir)
    return profiling.cardinality_classes(rows, rows.count())


@query
def validate_table(spark, sf_dir):
    return rounded(measure({"customers": customers(spark, sf_dir)}))


def _measured_by_week(spark, sf_dir):
    """Root of the states of the events, each week measured by itself."""
    slot = (spark.sparkContext.applicationId, sf_dir, "weeks")
    if slot not in _LANDED or not path_exists(spark, _LANDED[slot]):
        root, events = new_path(spark, "states"), table(spark, sf_dir, "events")
        week = F.weekofyear("ts")
        for row in events.select(week.alias("week")).distinct().orderBy("week").collect():  # a row per week
            states.add_day(events.where(week == row.week), root, str(row.week))
        _LANDED[slot] = root
    return _LANDED[slot]


SKETCHED = ["median_value", "lower_bound", "upper_bound", "outlier_count", "outlier_pct"]


@query
def validate_incremental(spark, sf_dir):
    """The report of all weeks from the states of each; what is read off sketches is in the next query."""
    found = states.merged(spark, _measured_by_week(spark, sf_dir), "events")
    return rounded(found.where(~F.col("metric").isin(SKETCHED)), 4)


@query
def sketched_ranks(spark, sf_dir):
    """Whether the merged medians have the middle rank, and outliers are counted right, within the stated error."""
    found = materialized(states.merged(spark, _measured_by_week(spark, sf_dir), "events"), "merged")
    events = table(spark, sf_dir, "events")
    numbers = numeric_columns(events)
    value = {(r.column_name, r.metric): r.value for r in found.where(F.col("metric").isin(SKETCHED)).collect()}
    cells = []
    for c in numbers:
        x, n = col(c).cast("double"), F.count(col(c))
        middle, low, high = (F.lit(value[c, m]) for m in ("median_value", "lower_bound", "upper_bound"))
        off = F.lit(states.RANK_ERROR) + 1 / n
        near = (F.count_if(x < middle) / n <= 0.5 + off) & (F.count_if(x <= middle) / n >= 0.5 - off)
        outside = F.count_if((x < low) | (x > high))
        right = F.abs(outside - F.lit(value[c, "outlier_count"])) <= 2 * off * n
        cells.append(F.struct(F.lit(c).alias("column_name"), near.alias("median_is_near"), right.alias("outliers_are_near")))
    return events.agg(F.array(*cells).alias("found")).select(F.inline("found"))


@query
def validation_report(spark, sf_dir):
    rows = customers(spark, sf_dir)
    sheets = reporting.report_sheets(measure({"customers": rows}), rows)
    paths = reporting.write_report(sheets, new_path(spark, "report"))
    outliers = spark.read.schema(sheets["outliers"].schema).json(paths["outliers"])
    missing = spark.read.schema(sheets["missing_values"].schema).json(paths["missing_values"])
    return rounded(missing.join(outliers, ["dataset", "column_name"], "left"))


@query
def validation_summary(spark, sf_dir):
    return validate_tables({"customers": customers(spark, sf_dir)})["issues"]


@query
def validate_combined(spark, sf_dir):
    pair = {"customers": customers(spark, sf_dir), "orders": table(spark, sf_dir, "orders")}
    return validate_tables(pair)["combined"]


@query
def validate_all(spark, sf_dir):
    found = validate_folder(spark, sf_dir)
    counts = found["measures"].where("check = 'shape'").groupBy("dataset").pivot(
        "metric", ["row_count", "column_count"]
    ).agg(F.first("value").cast("bigint"))
    issues = found["issues"].groupBy("dataset").agg(F.count("*").alias("issue_count"))
    joined = counts.join(issues, "dataset", "left")
    return joined.withColumn("issue_count", F.coalesce("issue_count", F.lit(0).cast("bigint")))


# --- cleaning and encoding --------------------------------------------------


@query
def coerce_numeric(spark, sf_dir):
    return rounded(
        cleaning.coerce_numeric(customers(spark, sf_dir), ["TotalCharges"]).select(KEY, "tenure", "TotalCharges")
    )


@query
def recode_values(spark, sf_dir):
    return cleaning.recode(customers(spark, sf_dir), "SeniorCitizen", {0: "No", 1: "Yes"}).select(
        KEY, "SeniorCitizen"
    )


@query
def standardize_yes_no(spark, sf_dir):
    rows = customers(spark, sf_dir)
    found = cleaning.fit_yes_no(rows)
    return cleaning.standardize_yes_no(rows, found).select(KEY, *found)


@query
def impute_median(spark, sf_dir):
    rows = typed(customers(spark, sf_dir)).select(KEY, "tenure", "TotalCharges")
    return rounded(cleaning.fill_missing(rows, cleaning.fit_fill(rows, ["tenure", "TotalCharges"])))


@query
def impute_mode(spark, sf_dir):
    rows = customers(spark, sf_dir).select(KEY, "Contract", "PaymentMethod")
    return cleaning.fill_missing(rows, cleaning.fit_fill(rows, ["Contract", "PaymentMethod"]))


@query
def drop_duplicates(spark, sf_dir):
    return rounded(cleaning.drop_duplicates(customers(spark, sf_dir)))


@query
def cap_outliers_iqr(spark, sf_dir):
    rows = customers(spark, sf_dir).select(KEY, "SeniorCitizen", "tenure", "MonthlyCharges")
    return rounded(cleaning.cap_outliers(rows, cleaning.fit_caps(rows)))


@query
def capped_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*MONEY)
    return rounded(cleaning.capped_counts(rows, cleaning.fit_caps(rows)))


@query
def cap_outliers_zscore(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rounded(cleaning.cap_outliers(rows, cleaning.fit_caps(rows, ["o_totalprice"], "zscore")))


@query
def cap_outliers_pct(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rounded(cleaning.cap_outliers(rows, cleaning.fit_caps(rows, ["o_totalprice"], "cap")))


@query
def encode_binary(spark, sf_dir):
    rows = customers(spark, sf_dir)
    rows = cleaning.standardize_yes_no(rows, cleaning.fit_yes_no(rows))
    binary = cleaning.fit_only_values(rows, profiling.string_columns(rows, [KEY]), ["Yes", "No"])
    return encoding.encode_binary(rows, binary).select(KEY, *binary)


@query
def route_cardinality(spark, sf_dir):
    return encoding.route_cardinality(table(spark, sf_dir, "part"))


@query
def encode_label(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return encoding.encode_label(rows, "p_name", encoding.label_dictionary(rows, "p_name"))


@query
def encode_label_texts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoding.encode_label(rows, "text", encoding.label_dictionary(rows, "text"))


@query
def encode_one_hot(spark, sf_dir):
    rows = customers(spark, sf_dir).select(KEY, "Contract", "InternetService", "MultipleLines")
    return encoding.encode_one_hot(rows, encoding.fit_categories(rows, rows.columns[1:]))


@query
def prepare_table(spark, sf_dir):
    return rounded(prepare(customers(spark, sf_dir))[0])


@query
def prepare_pair(spark, sf_dir):
    rows = customers(spark, sf_dir)
    both = prepare_all({"store_a": rows, "store_b": rows.withColumn("tenure", F.col("tenure") + 1)})
    out = None
    for name, df in both.items():
        part = df.agg(
            F.lit(name).alias("dataset"),
            F.count("*").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            F.avg("tenure").alias("mean_tenure"),
            F.avg("TotalCharges").alias("mean_total"),
        )
        out = part if out is None else out.unionByName(part)
    return rounded(out)


@query
def prep_report_summary(spark, sf_dir):
    return reporting.comparison_summary(customers(spark, sf_dir), prepared_customers(spark, sf_dir))


@query
def prep_report_columns(spark, sf_dir):
    return reporting.comparison_columns(customers(spark, sf_dir), prepared_customers(spark, sf_dir))


@query
def eda_histogram(spark, sf_dir):
    return rounded(exploring.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query
def eda_boxplot_by_class(spark, sf_dir):
    return rounded(exploring.boxplot_by_class(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_returnflag"))


@query
def eda_boxplot_by_customer(spark, sf_dir):
    """As many classes as there are customers."""
    return rounded(exploring.boxplot_by_class(table(spark, sf_dir, "orders"), "o_totalprice", "o_custkey"))


@query
def eda_correlation_features(spark, sf_dir):
    """All pairs of the features."""
    rows = customer_features(spark, sf_dir).drop(KEY, "Churn")
    found = rounded(exploring.correlation(rows), 4)
    return found.where("correlation IS NOT NULL AND NOT isnan(correlation)")


@query
def eda_correlation(spark, sf_dir):
    return rounded(exploring.correlation(table(spark, sf_dir, "lineitem"), MONEY))


# --- features ---------------------------------------------------------------


def _typed_charges(spark, sf_dir):
    return typed(customers(spark, sf_dir)).select(KEY, "tenure", "MonthlyCharges", "TotalCharges")


@query
def bin_tenure(spark, sf_dir):
    return customers(spark, sf_dir).select(
        KEY, "tenure", features.tenure_group(F.col("tenure")).alias("tenure_group")
    )


@query
def tenure_math(spark, sf_dir):
    rows = features.add_tenure_features(customers(spark, sf_dir).select(KEY, "tenure"))
    return rounded(rows.select(KEY, "tenure_years", "tenure_squared", "tenure_log"))


@query
def tenure_one_hot(spark, sf_dir):
    rows = features.add_tenure_features(customers(spark, sf_dir).select(KEY, "tenure"))
    return rows.drop("tenure", "tenure_years", "tenure_squared", "tenure_log")


@query
def ratio_avg_monthly(spark, sf_dir):
    rows = _typed_charges(spark, sf_dir)
    value = ratio(F.coalesce("TotalCharges", "MonthlyCharges"), F.col("tenure"))
    return rounded(rows.select(KEY, value.alias("avg_monthly_charges")))


@query
def ratio_total_monthly(spark, sf_dir):
    rows = features.add_financial_features(_typed_charges(spark, sf_dir))
    return rounded(rows.select(KEY, "avg_monthly_charges", "total_to_monthly_ratio"))


@query
def bin_monthly(spark, sf_dir):
    rows = features.add_financial_features(_typed_charges(spark, sf_dir))
    label = features.monthly_group(F.col("MonthlyCharges")).alias("monthly_group")
    return rows.select(KEY, label, *[c for c in rows.columns if c.startswith("monthly_charges_")])


@query
def bin_total(spark, sf_dir):
    rows = features.add_financial_features(_typed_charges(spark, sf_dir))
    label = features.total_group(F.col("TotalCharges")).alias("total_group")
    return rows.select(KEY, label, *[c for c in rows.columns if c.startswith("total_charges_")])


@query
def service_total(spark, sf_dir):
    return features.add_service_features(prepared_customers(spark, sf_dir)).select(KEY, "total_services")


@query
def service_density(spark, sf_dir):
    return rounded(features.add_service_features(prepared_customers(spark, sf_dir)).select(KEY, "service_density"))


@query
def service_premium(spark, sf_dir):
    return features.add_service_features(prepared_customers(spark, sf_dir)).select(KEY, "has_premium_services")


@query
def interact_tenure_monthly(spark, sf_dir):
    return rounded(customer_features(spark, sf_dir).select(KEY, "tenure_monthly_interaction"))


@query
def interact_contract_payment(spark, sf_dir):
    rows = customer_features(spark, sf_dir)
    crossed = [c for c in rows.columns if c.startswith("Contract_") and c.endswith("_interaction")]
    return rows.select(KEY, *[col(c) for c in crossed])


@query
def interact_senior_service(spark, sf_dir):
    return customer_features(spark, sf_dir).select(KEY, "senior_service_interaction")


@query
def transform_table(spark, sf_dir):
    return rounded(feature_table(customers(spark, sf_dir)))


def _scaled_lines(spark, sf_dir, method):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *MONEY)
    return rounded(scaling.scale(rows, scaling.fit_scaling(rows, MONEY, method)))


@query
def scale_standard(spark, sf_dir):
    return _scaled_lines(spark, sf_dir, "standard")


@query
def scale_minmax(spark, sf_dir):
    return _scaled_lines(spark, sf_dir, "minmax")


@query
def scale_robust(spark, sf_dir):
    return _scaled_lines(spark, sf_dir, "robust")


@query
def anova_f_scores(spark, sf_dir):
    rows = customer_features(spark, sf_dir)
    return rounded(scaling.anova_scores(rows, "Churn", numeric_columns(rows, ["Churn"])), 4)


@query
def select_k_best(spark, sf_dir):
    chosen = scaling.select_k_best(customer_features(spark, sf_dir), "Churn", 20, [KEY])
    totals = {"row_count": ("count({c})", "bigint"), "mean_value": ("avg({c})", "double")}
    return rounded(profiling.per_column(chosen, numeric_columns(chosen), totals))


@query
def transform_scaled(spark, sf_dir):
    """Scaled features, the 20 that separate the classes best, as a row for each value."""
    best = transform(prepared_customers(spark, sf_dir), scaling="standard", k_best=20)
    names = [c for c in best.columns if c != KEY]
    values = best.select(KEY, *[col(c).cast("double").alias(c) for c in names])
    return rounded(values.unpivot([KEY], [col(c) for c in names], "column_name", "value"))


@query
def split_features_labels(spark, sf_dir):
    x, y = features.split_features_labels(customer_features(spark, sf_dir), KEY)
    return x.select(KEY, "tenure_squared", F.lit(len(x.columns) - 1).alias("feature_count")).join(y, KEY)


# --- feature store and versions ---------------------------------------------


def _event_sets(spark, sf_dir):
    """Events as feature sets: the name is the type, the version the day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"),
        F.to_date("ts").cast("string").alias("version"),
        "ts",
        "user_id",
        "value",
        "props",
    )


def _event_log(spark, sf_dir):
    """Each day stored twice: in the morning, and again when it is complete."""
    rows = _event_sets(spark, sf_dir)
    early = rows.where(F.hour("ts") < 12)

    def entries(df):
        return df.groupBy("name", "version").agg(
            F.max("ts").cast("string").alias("created_at"), F.count("*").alias("row_count")
        )

    return entries(early).unionByName(entries(rows))


@query
def feature_registry(spark, sf_dir):
    return feature_store.current(_event_log(spark, sf_dir)).select("name", "version", "row_count")


@query
def feature_store_list(spark, sf_dir):
    return feature_store.newest_first(feature_store.current(_event_log(spark, sf_dir))).select(
        "name", "version", "row_count"
    )


@query
def feature_column_stats(spark, sf_dir):
    return rounded(
        feature_store.column_statistics(
            _event_sets(spark, sf_dir), ["user_id", "value", "props"], by=["name", "version"]
        ),
        4,
    )


@query
def feature_catalog(spark, sf_dir):
    registry = feature_store.current(_event_log(spark, sf_dir))
    statistics = feature_store.column_statistics(
        _event_sets(spark, sf_dir), ["user_id", "value", "props"], by=["name", "version"]
    )
    return rounded(feature_store.feature_catalog(registry, statistics).drop("created_at"), 4)


def _charge_table(spark, sf_dir):
    return typed(customers(spark, sf_dir)).select(KEY, "tenure", "MonthlyCharges", "TotalCharges", "Churn").distinct()


@query
def feature_store_write(spark, sf_dir):
    entry = feature_store.store_features(
        customer_features(spark, sf_dir), new_path(spark, "store"), KEY, "Churn", version="1"
    )
    return entry.select("name", "version", "description", "feature_count", "row_count", "key", "label")


@query
def feature_store_latest(spark, sf_dir):
    root = new_path(spark, "store")
    rows = _charge_table(spark, sf_dir)
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    feature_store.store_features(rows, root, KEY, "Churn", "charges", "a", created_at=first)
    feature_store.store_features(
        rows.withColumn("tenure", F.col("tenure") + 1), root, KEY, "Churn", "charges", "b", created_at=second
    )
    x, y = feature_store.load_features(spark, root, "charges")
    return rounded(x.join(y, KEY))


@query
def feature_set_metadata(spark, sf_dir):
    return rounded(feature_store.column_statistics(prepared_customers(spark, sf_dir).drop(KEY, "Churn")), 4)


@query
def label_distribution(spark, sf_dir):
    return feature_store.label_distribution(prepared_customers(spark, sf_dir), "Churn")


@query
def stored_label_distribution(spark, sf_dir):
    root = new_path(spark, "store")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for rows in (orders, orders.where("o_totalprice > 1000")):  # the second replaces the first
        feature_store.store_features(rows, root, "o_orderkey", "o_orderstatus", "orders", "a")
    return feature_store.stored_labels(spark, root)


@query
def dataset_fingerprint(spark, sf_dir):
    return versioning.fingerprint(table(spark, sf_dir, "lineitem"))


@query
def version_record(spark, sf_dir):
    entry = versioning.record_version(table(spark, sf_dir, "lineitem"), new_path(spark, "versions"), "l_returnflag")
    return entry.drop("version_tag", "created_at")


@query
def version_history(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"), F.to_date("ts").cast("string").alias("version"), "*"
    )
    columns = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return versioning.history(versioning.fingerprint(days, columns, by=["name", "version"]), "version", by=["name"])


@query
def version_log(spark, sf_dir):
    """The history a version log holds: the table, the same again, and the table without returned lines."""
    root, lines = new_path(spark, "versions"), table(spark, sf_dir, "lineitem")
    for day, rows in enumerate([lines, lines, lines.where("l_returnflag <> 'R'")], 1):
        versioning.record_version(rows, root, "l_returnflag", dt.datetime(2024, 1, day))
    return versioning.history(versioning.load_versions(spark, root)).select(
        "version_tag", "row_count", "fingerprint", "row_change", "content_changed"
    )


@query
def stored_feature_catalog(spark, sf_dir):
    """The catalog as stored: two sets, one of them stored again with fewer rows."""
    root, rows = new_path(spark, "store"), _charge_table(spark, sf_dir)
    moment = dt.datetime(2024, 1, 1)
    feature_store.store_features(rows, root, KEY, "Churn", "charges", "a", created_at=moment)
    feature_store.store_features(rows.drop("tenure"), root, KEY, "Churn", "money", "a", created_at=moment)
    feature_store.store_features(
        rows.where("tenure > 0"), root, KEY, "Churn", "charges", "a", created_at=moment + dt.timedelta(days=1)
    )
    listed = feature_store.list_features(spark, root).select("name", "version", "row_count", "feature_count")
    found = feature_store.stored_catalog(spark, root)
    names = found.groupBy("name", "version").agg(F.count("*").alias("catalog_rows"))
    return listed.join(names, ["name", "version"])


# --- models -----------------------------------------------------------------


@query
def model_matrix(spark, sf_dir):
    rows = typed(customers(spark, sf_dir)).withColumn("Churn", (F.col("Churn") == "Yes").cast("int"))
    return rounded(models.model_matrix(rows, "Churn", [KEY]).frame)


@query
def stratified_split(spark, sf_dir):
    rows = prepared_customers(spark, sf_dir).select(KEY, "Churn")
    return splitting.stratified_split(rows, [KEY], "Churn")


@query
def stratified_split_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_returnflag")
    marked = splitting.stratified_split(rows, LINE_KEYS, "l_returnflag")
    return marked.groupBy("l_returnflag", "split").agg(
        F.count("*").alias("row_count"), F.sum("l_orderkey").alias("order_total")
    )


@query
def hashed_split(spark, sf_dir):
    rows = prepared_customers(spark, sf_dir).select(KEY, "Churn")
    return splitting.hashed_split(rows, [KEY])


@query
def cv_folds(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_returnflag")
    return splitting.assign_folds(rows, LINE_KEYS).groupBy("l_returnflag", "fold").agg(
        F.count("*").alias("row_count")
    )


@query
def oversampled_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_returnflag")
    return splitting.oversample(rows, "l_returnflag", LINE_KEYS).groupBy("l_returnflag").agg(
        F.count("*").alias("row_count"), F.sum("l_orderkey").alias("order_total")
    )


CHARGES = ["tenure", "MonthlyCharges", "TotalCharges"]


def _evened_customers(spark, sf_dir):
    rows = prepared_customers(spark, sf_dir).select(KEY, "Churn", *CHARGES)
    return landed(spark, sf_dir, "evened", lambda: synthetic.add_synthetic(rows, "Churn", [KEY], CHARGES))


@query
def synthetic_customers(spark, sf_dir):
    """How often each customer is there once classes are even, and whether its values lie in the range of its class."""
    rows = _evened_customers(spark, sf_dir)
    ends = prepared_customers(spark, sf_dir).groupBy("Churn").agg(
        *[f(c).alias(f"{n}_{c}") for c in CHARGES for n, f in (("low", F.min), ("high", F.max))]
    )
    inside = [F.coalesce(F.col(c).between(F.col(f"low_{c}") - 1e-6, F.col(f"high_{c}") + 1e-6), F.lit(True)) for c in CHARGES]
    # two classes
    joined = rows.join(F.broadcast(ends), "Churn")
    return joined.groupBy(KEY, "Churn").agg(
        F.count("*").alias("row_count"), F.max("synthetic").alias("last_synthetic"), F.bool_and(inside[0] & inside[1] & inside[2]).alias("in_range")
    )


@query
def synthetic_lines(spark, sf_dir):
    """Lines with synthetic ones, by flag: as many as of the most frequent flag, between the values of their parents' class."""
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_returnflag", *MONEY)
    made = synthetic.add_synthetic(rows, "l_returnflag", LINE_KEYS, MONEY)
    return made.groupBy("l_returnflag").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("synthetic") > 0).alias("synthetic_count"),
        F.sum("l_orderkey").alias("order_total"), F.min("l_quantity").alias("min_quantity"), F.max("l_quantity").alias("max_quantity"),
    )


@query
def class_weights(spark, sf_dir):
    return rounded(splitting.class_weights(table(spark, sf_dir, "lineitem"), "l_returnflag"))


def _rule_scores(spark, sf_dir):
    """Returned lines, guessed from quantity and scored by price."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
        F.col("l_extendedprice").alias("score"),
    )


@query
def eval_confusion(spark, sf_dir):
    return evaluation.confusion(_rule_scores(spark, sf_dir), "label", "prediction")


@query
def eval_metrics(spark, sf_dir):
    return rounded(evaluation.metrics(evaluation.confusion(_rule_scores(spark, sf_dir), "label", "prediction")))


@query
def eval_roc_auc(spark, sf_dir):
    return rounded(evaluation.roc_auc(_rule_scores(spark, sf_dir), "label", "score"))


def _rule_models(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    guesses = {
        "by_discount": F.col("l_discount") > 0.05,
        "by_quantity": F.col("l_quantity") > 25,
        "by_tax": F.col("l_tax") < 0.03,
    }
    cells = [
        F.struct(F.lit(name).alias("model"), test.cast("int").alias("prediction")) for name, test in guesses.items()
    ]
    return lines.select((F.col("l_returnflag") == "R").cast("int").alias("label"), F.inline(F.array(*cells)))


@query
def model_comparison(spark, sf_dir):
    scored = evaluation.metrics(evaluation.confusion(_rule_models(spark, sf_dir), "label", "prediction", ["model"]))
    best = evaluation.best_model(scored)
    return rounded(
        evaluation.compare_models(scored)
        .select("model", "accuracy", "precision", "recall", "f1_score")
        .join(F.broadcast(best.select(F.col("best_model").alias("model"), F.lit(True).alias("is_best"))), "model", "left")
        .withColumn("is_best", F.coalesce("is_best", F.lit(False)))
    )


def _matrix(spark, sf_dir):
    """Feature matrix with split and fold, written once per application."""
    frame = landed(
        spark, sf_dir, "matrix", lambda: training_plan.training_matrix(customer_features(spark, sf_dir)).frame
    )
    features = numeric_columns(frame, ["Churn", "fold"])
    return models.Matrix(frame, features, "Churn", [KEY])


def _train_one(spark, sf_dir, name):
    matrix = _matrix(spark, sf_dir)
    model = models.train(name, matrix, training_plan.rows_of(matrix, "train"))
    return models.evaluate({name: model}, training_plan.rows_of(matrix, "test"), matrix.label)


@query
def train_logistic(spark, sf_dir):
    return _train_one(spark, sf_dir, "logistic_regression")


@query
def train_random_forest(spark, sf_dir):
    return _train_one(spark, sf_dir, "random_forest")


@query
def train_gbt(spark, sf_dir):
    return _train_one(spark, sf_dir, "gradient_boosting")


@query
def train_linear_svc(spark, sf_dir):
    return _train_one(spark, sf_dir, "linear_svc")


@query
def train_kernel_svc(spark, sf_dir):
    return _train_one(spark, sf_dir, "kernel_svc")


_TRAINED: dict[tuple, str] = {}


def _training(spark, sf_dir):
    """All classifiers, trained and saved by the first query that needs them in this application."""
    slot = (spark.sparkContext.applicationId, sf_dir)
    matrix = _matrix(spark, sf_dir)
    if slot not in _TRAINED or not path_exists(spark, _TRAINED[slot]):
        root = new_path(spark, "training")
        training_plan.save(training_plan.train_and_compare(matrix), root)
        _TRAINED[slot] = root
    return training_plan.load(matrix, _TRAINED[slot])


@query
def train_and_evaluate(spark, sf_dir):
    training = _training(spark, sf_dir)
    return training.results.withColumn("is_best", F.col("model") == training.best)


@query
def model_report(spark, sf_dir):
    return training_plan.report(_training(spark, sf_dir))


@query
def feature_importance(spark, sf_dir):
    training = _training(spark, sf_dir)
    return models.feature_importance(
        training.models["random_forest"], training.matrix.features, training.matrix.frame
    )


@query
def permutation_importance(spark, sf_dir):
    """What each feature is worth to the kernel machine, which has no weights of features."""
    training = _training(spark, sf_dir)
    test = training_plan.rows_of(training.matrix, "test")
    return models.permutation_importance(training.models["kernel_svc"], training.matrix, test)


def _kernel_scores(spark, sf_dir):
    training = _training(spark, sf_dir)
    test = training_plan.rows_of(training.matrix, "test")
    return models.score(training.models["kernel_svc"], test, training.matrix.label, [KEY])


@query
def kernel_svc_calibration(spark, sf_dir):
    return kernel_machine.calibration(_kernel_scores(spark, sf_dir))


@query
def cv_scores(spark, sf_dir):
    return training_plan.cross_validate_best(_training(spark, sf_dir))


# Measured values differ from one engine to the next, so the following results
# hold what any right training gives: which rows were used, and that the
# measures agree with each other.


def _agree(results: DataFrame) -> DataFrame:
    rows = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    shares = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    in_range = F.forall(F.array(*shares), lambda x: (x >= 0) & (x <= 1))
    same = F.abs(F.col("accuracy") - (F.col("tp") + F.col("tn")) / rows) < 1e-9
    return results.select(
        "model",
        rows.alias("test_rows"),
        (F.col("tp") + F.col("fn")).alias("positive_rows"),
        in_range.alias("shares_in_range"),
        same.alias("accuracy_agrees"),
    )


@query
def trained_model_facts(spark, sf_dir):
    return _agree(_training(spark, sf_dir).results)


@query
def kernel_svc_facts(spark, sf_dir):
    """Probabilities of the held-out rows: shares, in the order of the predictions, near the share of positives, better than chance."""
    scored = materialized(_kernel_scores(spark, sf_dir), "kernel-scores")
    area = evaluation.roc_auc(scored, "label", "score").select((F.col("roc_auc") > 0.6).alias("ranks_well"))
    bins = kernel_machine.calibration(scored, 5)
    mean = F.col("mean_score")
    by_chance = 3 * F.sqrt(mean * (1 - mean) / F.col("row_count"))  # three standard errors
    near = bins.agg(F.bool_and(F.abs(mean - F.col("positive_share")) <= 0.05 + by_chance).alias("is_calibrated"))
    facts = scored.agg(
        F.count("*").alias("test_rows"),
        F.count_if(F.col("label") == 1).alias("positive_rows"),
        (F.count_if(F.col("score").between(0, 1)) == F.count("*")).alias("scores_are_shares"),
        F.coalesce(
            F.max(F.when(F.col("prediction") == 0, F.col("score"))) <= F.min(F.when(F.col("prediction") == 1, F.col("score"))),
            F.lit(True),
        ).alias("predictions_follow_scores"),
    )
    # one row each
    return facts.crossJoin(F.broadcast(area)).crossJoin(F.broadcast(near))


@query
def weighted_model_facts(spark, sf_dir):
    return _agree(train_weighted(spark, sf_dir))


@query
def best_model_facts(spark, sf_dir):
    """The chosen model has the highest F1, is reported as best, and is the one that is cross-validated."""
    training = _training(spark, sf_dir)
    top = training.results.agg(F.max("f1_score").alias("top"))
    chosen = training.results.where(F.col("model") == training.best).select("f1_score")
    report = training_plan.report(training).groupBy("section").agg(F.count("*").alias("item_count"))
    return report.crossJoin(F.broadcast(top.join(chosen, F.col("top") == F.col("f1_score")).select(F.lit(True).alias("is_top"))))


@query
def importance_facts(spark, sf_dir):
    found = feature_importance(spark, sf_dir)
    return found.agg(
        F.count("*").alias("feature_count"),
        (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"),
        (F.min("importance") >= 0).alias("none_negative"),
    )


@query
def fold_facts(spark, sf_dir):
    """Each row is held out once, and the summary is that of the folds."""
    matrix = _matrix(spark, sf_dir)
    held = matrix.frame.groupBy("fold").agg(F.count("*").alias("row_count"))
    scores = cv_scores(spark, sf_dir)
    mean = F.avg("f1_score").over(Window.partitionBy("model"))
    spread = F.stddev_pop("f1_score").over(Window.partitionBy("model"))  # five rows
    agrees = (F.abs(mean - F.col("cv_mean_f1")) < 1e-9) & (F.abs(spread - F.col("cv_std_f1")) < 1e-9)
    return held.join(scores.select("fold", agrees.alias("summary_agrees")), "fold")


@query
def component_facts(spark, sf_dir):
    shares = pca_components(spark, sf_dir)
    ordered = Window.orderBy("component")  # five rows
    falling = F.coalesce(F.col("explained_share") <= F.lag("explained_share").over(ordered), F.lit(True))
    return shares.select("component", falling.alias("not_above_the_one_before"), F.col("explained_share").between(0, 1).alias("is_share"))


@query
def tuning_facts(spark, sf_dir):
    return tune_logistic(spark, sf_dir).select("penalty", F.col("mean_auc").between(0, 1).alias("is_share"))


@query
def run_summary(spark, sf_dir):
    rows = customers(spark, sf_dir)
    return run({"store_a": rows, "store_b": rows}, new_path(spark, "run"), LAST_DAY)


# --- stated goals without an implementation to follow -----------------------


@query
def target_encoding(spark, sf_dir):
    rows = customers(spark, sf_dir).select(
        KEY, F.col("PaymentMethod").alias("payment"), (F.col("Churn") == "Yes").cast("int").alias("target")
    )
    return rounded(encoding.encode_target(rows, "payment", encoding.fit_target_means(rows, "payment", "target")))


@query
def target_encoding_out_of_fold(spark, sf_dir):
    """Churn by means of payment and, for many categories, by customer's monthly charge, each from the other folds."""
    rows = customers(spark, sf_dir).select(
        KEY, F.col("PaymentMethod").alias("payment"), F.floor("MonthlyCharges").cast("string").alias("charge"),
        (F.col("Churn") == "Yes").cast("int").alias("target"),
    )
    out = landed(spark, sf_dir, "customer-folds", lambda: splitting.assign_folds(rows, [KEY]))
    for column in ("payment", "charge"):
        out = encoding.encode_target_out_of_fold(out, column, "target", "fold")
    return rounded(out.drop("fold"))


@query
def drift_psi(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    return rounded(
        drift.population_stability(events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle), "value")
    )


@query
def train_weighted(spark, sf_dir):
    matrix = _matrix(spark, sf_dir)
    rows = splitting.with_class_weight(training_plan.rows_of(matrix, "train"), matrix.label)
    model = models.train("logistic_regression", matrix, rows, weight="class_weight")
    return models.evaluate({"logistic_regression": model}, training_plan.rows_of(matrix, "test"), matrix.label)


@query
def quality_score(spark, sf_dir):
    rules = {
        "blank_total": "trim(TotalCharges) <> ''",
        "known_payment": "PaymentMethod IS NOT NULL",
        "tenure_in_range": "tenure BETWEEN 0 AND 72",
        "positive_charge": "MonthlyCharges > 0",
    }
    return rounded(drift.quality_shares(customers(spark, sf_dir), rules))


@query
def pca_components(spark, sf_dir):
    _, shares = models.principal_components(_matrix(spark, sf_dir), 5)
    return shares


@query
def pca_projection(spark, sf_dir):
    """Every customer's place on the five largest components."""
    matrix = _matrix(spark, sf_dir)
    return projection.project(matrix.frame, projection.fit_projection(matrix.frame, matrix.features, 5), [KEY])


@query
def projection_facts(spark, sf_dir):
    """The randomized components against an exact decomposition of all column pairs, and what projected rows must be like."""
    matrix = _matrix(spark, sf_dir)
    fitted = projection.fit_projection(matrix.frame, matrix.features, 5)
    rows = projection.project(matrix.frame, fitted, [KEY])
    _, shares = models.principal_components(matrix, 5)
    exact = {r.component: r.explained_share for r in shares.collect()}  # five numbers
    total = F.var_samp("component_1") / F.lit(fitted.shares[0])
    cells = [
        F.struct(
            F.lit(i).alias("component"),
            F.count("*").alias("row_count"),
            (F.abs(F.avg(f"component_{i}")) < 1e-6).alias("is_centred"),
            (F.abs(F.var_samp(f"component_{i}") / total - F.lit(share)) < 1e-6).alias("has_its_share"),
            (F.lit(abs(share - exact[i])) < 1e-4).alias("is_exact"),
            (F.abs(F.covar_samp(f"component_{i}", f"component_{i % 5 + 1}")) < 1e-6 * total).alias("is_uncorrelated"),
        )
        for i, share in enumerate(fitted.shares, 1)
    ]
    return rows.agg(F.array(*cells).alias("found")).select(F.inline("found"))


@query
def tune_logistic(spark, sf_dir):
    matrix = _matrix(spark, sf_dir)
    return models.tune_logistic(matrix, matrix.frame, [0.001, 0.01, 0.1], folds=5)


@query
def stream_features(spark, sf_dir):
    rows = customers(spark, sf_dir)
    _, learned = prepare(rows)
    slot = (spark.sparkContext.applicationId, sf_dir, "customers")
    arriving = scoring.read_stream(spark, _LANDED[slot], rows.schema)
    return rounded(scoring.write_available(scoring.stream_features(arriving, learned), new_path(spark, "stream")))


@query
def window_quality_batch(spark, sf_dir):
    return scoring.window_quality(table(spark, sf_dir, "events"), "ts", "event_type", "value")


@query
def window_quality_stream(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    arriving = scoring.read_stream(spark, sf_dir, events.schema, "events*.parquet")
    windows = scoring.window_quality(arriving, "ts", "event_type", "value")
    return scoring.write_updates(windows, new_path(spark, "stream"), ["window_start", "event_type"])


@query
def stream_without_repeats(spark, sf_dir):
    """Events in two runs of one checkpoint, the second with copies of what the first has seen and with rows that come too late."""
    events, folder = table(spark, sf_dir, "events"), new_path(spark, "arriving")
    out, middle = new_path(spark, "stream"), F.lit("2024-01-16").cast("timestamp_ntz")
    first, second = events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)
    copies = first.where(F.col("ts") >= middle - F.expr("interval 1 day"))
    late = first.where(F.col("ts") < middle - F.expr("interval 5 days")).withColumn("event_id", -1 - F.col("event_id"))
    for arriving in (first.unionByName(first.where("event_id % 3 = 0")), second.unionByName(copies).unionByName(late)):
        arriving.write.mode("append").parquet(folder)
        rows = scoring.read_stream(spark, folder, events.schema)
        timed = rows.withColumn("ts", F.col("ts").cast("timestamp"))
        found = scoring.write_available(scoring.without_repeats(timed, ["event_id"], "ts", "2 days"), out)
    return found.groupBy("event_type").agg(
        F.count("*").alias("row_count"), F.count_distinct("event_id").alias("event_count"), F.sum("event_id").alias("id_total")
    )


@query
def stream_scores(spark, sf_dir):
    """Arriving rows scored by a model trained on a batch."""
    rows, training = customers(spark, sf_dir), _training(spark, sf_dir)
    _, learned = prepare(rows)
    slot = (spark.sparkContext.applicationId, sf_dir, "customers")
    arriving = scoring.read_stream(spark, _LANDED[slot], rows.schema)
    scored = scoring.stream_scores(arriving, learned, training.models["logistic_regression"], "Churn", [KEY])
    found = scoring.write_available(scored, new_path(spark, "stream"))
    likely = (F.col("score") > 0.5).cast("int")
    valid = F.col("score").between(0, 1) & ((F.col("prediction") == likely) | (F.col("score") == 0.5))
    return found.select(KEY, "label", valid.alias("is_valid"))
