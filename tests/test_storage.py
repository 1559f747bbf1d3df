"""Files, raw zone, snapshots, feature store, versions, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabloom.operators import feature_store, versioning
from tabloom.plans.customer_profile import COLUMNS, SCHEMA, customer_profile
from tabloom.plans.validate import validate_folder
from tabloom.sources import files, raw_zone, snapshots
from tabloom.sources.workspace import new_path, path_exists, workspace
from tabloom.streaming import scoring


def test_csv_keeps_blanks_and_reads_nan_as_missing(spark, tmp_path):
    df = spark.createDataFrame([(" ", 1.5), (None, float("nan")), ("a,b\"c", None)], "s string, d double")
    path = files.write_csv(df, str(tmp_path / "csv"))
    back = files.scan_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(" ", 1.5), (None, None), ('a,b"c', None)], key=str)
    assert dict(files.scan_csv(spark, path).dtypes)["d"] == "double"


def test_ingest_acquires_unless_all_are_landed(spark, tmp_path):
    calls = []

    def acquire(name):
        def build():
            calls.append(name)
            return spark.createDataFrame([(name,)], "s string")

        return build

    landed = {n: str(tmp_path / n) for n in "ab"}
    for _ in range(2):
        read = files.ingest(spark, landed, {n: acquire(n) for n in "ab"})
    assert calls == ["a", "b"] and read["b"].first().s == "b"
    assert files.first_existing(spark, [str(tmp_path / "none"), landed["a"]]) == landed["a"]
    assert files.first_existing(spark, [str(tmp_path / "none")]) is None


def test_raw_zone(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(10).select(F.col("id").alias("n"))
    for day in ("2024-01-01", "2024-01-20"):
        entry = raw_zone.store_raw(df, root, "t", "shop", day).first()
    raw_zone.store_raw(df.limit(3), root, "t", "web", "2024-01-20")
    assert (entry.row_count, entry.column_count, entry.columns) == (10, 1, "n") and entry.size_mb > 0
    again = raw_zone.store_raw(df.limit(4), root, "t", "shop", "2024-01-20").first()
    assert again.row_count == 4
    assert raw_zone.load_raw(spark, root, "t").count() == 17
    assert raw_zone.load_raw(spark, root, "t", "web").count() == 3
    plan = raw_zone.load_raw(spark, root, "t", "web")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    report = raw_zone.drop_expired(spark, root, "t", "2024-01-31", 20)
    assert {(r.source, r.state): r.row_count for r in report.collect()} == {
        ("shop", "expired"): 10, ("shop", "kept"): 4, ("web", "kept"): 3
    }
    assert raw_zone.load_raw(spark, root, "t").count() == 7


def test_raw_zone_takes_any_source(spark, tmp_path):
    root = str(tmp_path)
    sources = ["007", "a/b", None, "x=y z", "2024-01-01"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sources)] * 2, "n int, s string")
    for day in ("2024-01-01", "2024-01-20"):
        written = raw_zone.store_raw(df, root, "t", F.col("s"), F.lit(day))
        assert {r.source: (r.row_count, r.file_count) for r in written.collect()} == {s: (2, 1) for s in sources}
    assert {r.source for r in raw_zone.load_raw(spark, root, "t").collect()} == set(sources)
    assert raw_zone.load_raw(spark, root, "t", "007").count() == 4
    report = raw_zone.drop_expired(spark, root, "t", "2024-01-31", 20)
    assert {(r.source, r.state, r.row_count) for r in report.collect()} == {
        (s, state, 2) for s in sources for state in ("expired", "kept")
    }
    left = raw_zone.load_raw(spark, root, "t")
    assert left.count() == 10 and {str(r.ingest_date) for r in left.collect()} == {"2024-01-20"}


def test_landing_evaluates_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).selectExpr("id", "id % 3 AS kind").mapInArrow(count, "id long, kind long")
    raw_zone.store_raw(df, str(tmp_path), "t", F.col("kind"), F.lit("2024-01-01")).collect()
    assert seen.value == 100


def test_fingerprint_sees_every_column(spark):
    df = spark.createDataFrame([(1, 0.5, "a"), (2, float("nan"), None)], "k int, v double, t string")
    first = versioning.fingerprint(df).first()
    assert versioning.fingerprint(df.repartition(3)).first() == first
    for changed in (df.withColumn("v", F.col("v") + 1e-6), df.withColumn("t", F.coalesce("t", F.lit("")))):
        assert versioning.fingerprint(changed).first().fingerprint != first.fingerprint


def test_open_windows_are_written(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = spark.sql("SELECT timestamp'2024-01-01 00:10:00' AS ts, 'a' AS kind, 1.0D AS v")
    rows.write.parquet(folder)
    late = rows.selectExpr("ts + interval 20 minutes AS ts", "kind", "-v AS v")

    def run():
        stream = scoring.window_quality(scoring.read_stream(spark, folder, rows.schema), "ts", "kind", "v")
        return scoring.write_updates(stream, str(tmp_path / "out"), ["window_start", "kind"])

    assert [r.row_count for r in run().collect()] == [1]
    late.write.mode("append").parquet(folder)
    assert [(r.row_count, r.negative_count) for r in run().collect()] == [(2, 1)]  # the newer row of the same window


def test_tables_of_a_folder(spark, tmp_path):
    for name in ("b", "a"):
        spark.range(2).write.parquet(str(tmp_path / f"{name}.parquet"))
    (tmp_path / "notes.txt").write_text("no table")
    counts = validate_folder(spark, str(tmp_path))["measures"].where("metric = 'row_count'")
    assert sorted((r.dataset, r.value) for r in counts.collect()) == [("a", 2.0), ("b", 2.0)]


def test_columns_as_partitions_are_rebalanced(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") < 70, "big").otherwise("small").alias("kind"))
    written = raw_zone.store_raw(df, str(tmp_path), "t", F.col("kind"), F.lit("2024-01-01"))
    assert {r.source: r.row_count for r in written.collect()} == {"big": 70, "small": 30}
    hinted = df.withColumns({"source": F.col("kind"), "ingest_date": F.lit(1)}).hint(
        "rebalance", F.col("source"), F.col("ingest_date")
    )
    assert "RebalancePartitions" in hinted._jdf.queryExecution().optimizedPlan().toString()


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        snapshots.load_latest(spark, root, "t")
    other = str(tmp_path / "other")
    spark.range(1).write.parquet(other)
    assert snapshots.load_latest(spark, root, "t", [str(tmp_path / "no"), other]).count() == 1
    log = snapshots.save_table(spark.range(5), root, "t", dt.datetime(2024, 1, 2)).first()
    snapshots.save_table(spark.range(3), root, "t", dt.datetime(2024, 1, 1))
    assert (log.row_count, log.column_count, log.columns) == (5, 1, "id")
    assert snapshots.load_latest(spark, root, "t").count() == 5


def test_feature_store(spark, tmp_path):
    root = str(tmp_path)
    assert feature_store.list_features(spark, root).count() == 0

    def table(n):
        return spark.range(n).select(F.col("id").cast("string").alias("k"), F.col("id").alias("x"), F.lit(1).alias("y"))

    feature_store.store_features(table(5), root, "k", "y", "f", "1", created_at=dt.datetime(2024, 1, 1))
    feature_store.store_features(table(7), root, "k", "y", "f", "2", created_at=dt.datetime(2024, 1, 2))
    feature_store.store_features(table(6), root, "k", "y", "f", "1", created_at=dt.datetime(2024, 1, 3))
    listed = [(r.version, r.row_count) for r in feature_store.list_features(spark, root).collect()]
    assert listed == [("1", 6), ("2", 7)]
    x, y = feature_store.load_features(spark, root, "f")
    assert x.columns == ["k", "x"] and y.columns == ["k", "y"] and x.count() == 6
    assert feature_store.load_features(spark, root, "f", "2")[0].count() == 7
    found = {r.version: r.max_value for r in feature_store.stored_catalog(spark, root).collect()}
    assert found == {"1": 5.0, "2": 6.0}
    with pytest.raises(ValueError):
        feature_store.load_features(spark, root, "f", "3")


def test_statistics_per_group(spark):
    big = 2**53
    df = spark.createDataFrame(
        [("a", big, 0.0, "x" * 500, True), ("a", big + 1, -0.0, "x" * 500, False), ("b", None, float("nan"), None, None)],
        "g string, i bigint, d double, s string, t boolean",
    )
    found = {(r.g, r.column_name): r for r in feature_store.column_statistics(df, by=["g"]).collect()}
    assert found["a", "i"].unique_count == 2 and found["a", "d"].unique_count == 1
    assert found["a", "s"].unique_count == 1 and found["a", "s"].min_value is None and found["a", "t"].unique_count == 2
    assert found["b", "d"].null_count == 1 and found["b", "s"].unique_count == 0
    assert found["a", "i"].data_type == "bigint"


def test_fingerprint(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("s"))
    base = versioning.fingerprint(df).first()
    assert versioning.fingerprint(df.repartition(13)).first() == base
    assert versioning.fingerprint(df.union(df.limit(1))).first() != base
    assert versioning.fingerprint(df.withColumn("s", F.lit(None).cast("string"))).first().fingerprint != base.fingerprint


def test_version_log(spark, tmp_path):
    root = str(tmp_path)
    for day, n in ((1, 5), (2, 8), (3, 8)):
        versioning.record_version(spark.range(n), root, "none", dt.datetime(2024, 1, day))
    log = versioning.history(versioning.load_versions(spark, root)).collect()
    assert [(r.row_count, r.row_change, r.content_changed) for r in log] == [(8, 0, False), (8, 3, True), (5, None, True)]
    assert log[0].version_tag == "v20240103_000000"


def test_profile_schema(spark, tables):
    df = customer_profile(spark, tables)
    assert df.columns == COLUMNS
    assert [t for _, t in df.dtypes] == [t for _, t in spark.createDataFrame([], SCHEMA).dtypes]


def test_workspace(spark):
    assert workspace(spark).startswith("file:") or workspace(spark).startswith("/")
    assert not path_exists(spark, new_path(spark, "x"))


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id bigint, ts timestamp, kind string, value double"

    def arrive(ids, hour):
        rows = [(i, dt.datetime(2024, 1, 1, hour, i % 60), "a", float(i) - 2) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)

    arrive(range(5), 1)
    plain = scoring.read_stream(spark, folder, schema)
    assert scoring.write_available(plain, out).count() == 5
    arrive(range(5, 8), 3)
    assert scoring.write_available(plain, out).count() == 8

    windows = scoring.write_available(scoring.window_quality(plain, "ts", "kind", "value"), str(tmp_path / "w"))
    row = windows.first()
    assert windows.count() == 1 and (row.row_count, row.negative_count) == (5, 2)
    once = scoring.write_available(scoring.without_repeats(plain, ["kind"], "ts", "1 day"), str(tmp_path / "d"))
    assert once.count() == 1
