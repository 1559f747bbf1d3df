"""Commits: whole or not at all, one winner, no look at what was there before."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import datetime as dt
import pytest
from pyspark.sql import functions as F

from tabloom.operators import feature_store, versioning
from tabloom.sources import raw_zone
from tabloom.sources.commits import CommitLog, Conflict

SCHEMA = "number bigint, k string, v int"


def test_numbers_and_lines(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), SCHEMA)
    assert log.newest() == 0 and log.read().count() == 0
    for i in range(1, 12):
        assert log.append([{"k": f"k{i}", "v": i}, {"k": None, "v": -i}], log.newest()) == i
    assert log.newest() == 11
    assert sorted((r.number, r.v) for r in log.read(after=9).collect()) == [(10, -10), (10, 10), (11, -11), (11, 11)]
    assert log.read().count() == 22
    assert not [f.name for f in (tmp_path / "log").iterdir() if "draft" in f.name and f.name.endswith("json")]


def test_a_number_is_taken_once(spark, tmp_path):
    """Many writers at once: all commits are there, each once, without gaps."""
    log = CommitLog(spark, str(tmp_path), SCHEMA)
    start = Barrier(8)

    def write(i):
        start.wait()
        return [log.append([{"k": f"{i}.{j}", "v": i}], 0) for j in range(5)]

    with ThreadPoolExecutor(8) as pool:
        numbers = [n for found in pool.map(write, range(8)) for n in found]
    assert sorted(numbers) == list(range(1, 41))
    assert log.read().select("k").distinct().count() == 40


def test_the_same_thing_is_won_by_one_writer(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path), SCHEMA)
    base = log.newest()
    start = Barrier(6)

    def write(i):
        start.wait()
        try:
            return log.append([{"k": None if i % 2 else "same", "v": i}], base, ["k"])
        except Conflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = [n for n in pool.map(write, range(6)) if n]
    assert len(won) == 2  # one for each value, a missing one included
    assert log.append([{"k": "same", "v": 9}], log.newest(), ["k"]) == 3  # begun after the others


def test_two_landings_of_a_day(spark, tmp_path):
    root, start = str(tmp_path), Barrier(2)
    raw_zone.store_raw(spark.range(3), root, "t", "shop", "2024-01-01")

    def land(n):
        start.wait()
        try:
            return raw_zone.store_raw(spark.range(n), root, "t", "shop", "2024-01-02").first().row_count
        except Conflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        won = [n for n in pool.map(land, (10, 20)) if n]
    assert len(won) == 1
    rows = raw_zone.load_raw(spark, root, "t")
    assert {str(r.ingest_date): r["count"] for r in rows.groupBy("ingest_date").count().collect()} == {
        "2024-01-01": 3, "2024-01-02": won[0]
    }


def test_a_failed_landing_is_invisible(spark, tmp_path):
    root = str(tmp_path)
    raw_zone.store_raw(spark.range(3), root, "t", "shop", "2024-01-01")
    broken = spark.range(1000).select(F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        raw_zone.store_raw(broken.repartition(8), root, "t", "shop", "2024-01-01")
    assert raw_zone.load_raw(spark, root, "t").count() == 3
    # nor are files that were written, but never committed
    spark.range(50).write.parquet(f"{root}/t/landing=abc/source=shop/ingest_date=2024-01-01")
    assert raw_zone.load_raw(spark, root, "t").count() == 3 and raw_zone.catalog(spark, root, "t").count() <= 3


def test_a_landing_looks_at_its_own_files_only(spark, tmp_path):
    """What was there before may even be gone or broken."""
    root = str(tmp_path)
    raw_zone.store_raw(spark.range(3), root, "t", "shop", "2024-01-01")
    for part in (tmp_path / "t").rglob("*.parquet"):
        part.write_bytes(b"broken")
    for crc in (tmp_path / "t").rglob(".part*.crc"):
        crc.unlink()
    written = raw_zone.store_raw(spark.range(5), root, "t", "web", "2024-01-01").first()
    assert (written.row_count, written.file_count >= 1) == (5, True)
    plan = raw_zone.load_raw(spark, root, "t", "web")
    assert plan.count() == 5 and all("source=web" in f for f in plan.inputFiles())


def test_replaced_days_and_changed_columns(spark, tmp_path):
    root = str(tmp_path)
    raw_zone.store_raw(spark.range(3).toDF("a"), root, "t", "shop", "2024-01-01")
    raw_zone.store_raw(spark.range(4).selectExpr("id AS a", "1 AS b"), root, "t", "shop", "2024-01-02")
    raw_zone.store_raw(spark.range(5).selectExpr("id AS a", "1 AS b"), root, "t", "shop", "2024-01-02")
    rows = raw_zone.load_raw(spark, root, "t")
    assert rows.columns == ["a", "b", "source", "ingest_date"] and rows.count() == 8 and rows.where("b IS NULL").count() == 3
    assert raw_zone.drop_replaced(spark, root, "t") == 1
    assert raw_zone.load_raw(spark, root, "t").count() == 8
    assert raw_zone.store_raw(spark.range(0).toDF("a"), root, "t", "shop", "2024-01-03").count() == 0
    with pytest.raises(FileNotFoundError):
        raw_zone.load_raw(spark, root, "other")
    raw_zone.store_raw(spark.range(0).toDF("a"), root, "none", "shop", "2024-01-03")
    assert raw_zone.load_raw(spark, root, "none").count() == 0


def test_registry_and_versions(spark, tmp_path):
    root, start = str(tmp_path), Barrier(2)
    rows = spark.range(6).select(F.col("id").alias("k"), F.col("id").alias("x"), (F.col("id") % 2).alias("y"))

    def store(_):
        start.wait()
        try:
            return feature_store.store_features(rows, root, "k", "y", "f", "1", created_at=dt.datetime(2024, 1, 1)).first().location
        except Conflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(store, range(2)))
    assert feature_store.list_features(spark, root).count() == 1
    assert {(r.label, r.label_count) for r in feature_store.stored_labels(spark, root).collect()} == {("0", 3), ("1", 3)}
    moment = dt.datetime(2024, 1, 1, 12)
    versioning.record_version(rows, root, "y", moment)
    with pytest.raises(Conflict):
        versioning.record_version(rows, root, "y", moment)
    assert versioning.load_versions(spark, root).count() == 1
    assert versioning.load_versions(spark, root).first().created_at == moment
