"""Uniqueness and one-station reads from sorted files, without a shuffle of rows."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import sorted_files
from tidewater.sinks import silver
from tidewater.sinks.bronze import write_bronze_frame
from tidewater.plans.silver_load import run_silver

START = dt.datetime(2015, 1, 1)


def written(spark, path, files):
    """Files of (buoy, minute) keys, one task each."""
    for keys in files:
        rows = [(b, START + dt.timedelta(minutes=m)) for b, m in keys]
        spark.createDataFrame(rows, "buoy_id string, datetime timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def violations(spark, path, files):
    return {r["check"]: r["violations"] for r in sorted_files.neighbour_check(sorted_files.stretches(written(spark, path, files))).collect()}


@pytest.mark.parametrize(
    "files, repeated, unordered",
    [
        ([[("1", 1), ("1", 2), ("2", 1)], [("2", 2), ("3", 1)]], 0, 0),
        ([[("1", 1), ("1", 1), ("2", 1)], [("2", 2)]], 1, 0),
        ([[("1", 1), ("2", 1)], [("2", 1), ("3", 1)]], 1, 0),  # across a file bound
        ([[("1", 1)], [("1", 1)], [("1", 1)]], 2, 0),
        ([[("1", 2), ("1", 1)], [("2", 2)]], 0, 1),
        ([[("1", 1), ("3", 1)], [("2", 1)]], 0, 1),  # files that overlap
        ([[("10", 1), ("9", 1)]], 0, 0),  # text order
    ],
)
def test_neighbours(spark, root, files, repeated, unordered):
    found = violations(spark, root, files)
    assert (found["unique_key"], found["sorted_files"]) == (repeated, unordered)


def test_empty_snapshot(spark, root):
    spark.createDataFrame([], "buoy_id string, datetime timestamp_ntz").write.mode("overwrite").parquet(root)
    found = sorted_files.neighbour_check(sorted_files.stretches(spark.read.schema("buoy_id string, datetime timestamp_ntz").parquet(root))).collect()
    assert {r["violations"] for r in found} == {0}


def test_many_scan_partitions_of_one_file(spark, root):
    """A file that several tasks read: the ends of their stretches are compared."""
    keys = spark.range(200_000).selectExpr("format_string('%05d', id DIV 1000) AS buoy_id", "TIMESTAMP_NTZ '2015-01-01' + make_interval(0, 0, 0, 0, 0, CAST(id % 1000 AS INT)) AS datetime")
    keys.coalesce(1).sortWithinPartitions("buoy_id", "datetime").write.option("parquet.block.size", 64 * 1024).option("compression", "uncompressed").mode("overwrite").parquet(root)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100KB")
    try:
        stretches = sorted_files.stretches(spark.read.parquet(root))
        assert stretches.count() > 3
        assert {r["violations"] for r in sorted_files.neighbour_check(stretches).collect()} == {0}
        plan = stretches._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        (index,) = sorted_files.file_index(stretches).collect()
        assert (index["rows"], index["first_buoy"], index["last_buoy"]) == (200_000, "00000", "00199")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_repeated_key_stops_the_publish(spark, root):
    rows = [("1", START, "2015"), ("1", START, "2015"), ("2", START, "2015")]
    typed = spark.createDataFrame(rows, "buoy_id string, datetime timestamp_ntz, load_year string")
    from tidewater.schema import SILVER_OBSERVATIONS

    for f in SILVER_OBSERVATIONS.fields[2:]:
        typed = typed.withColumn(f.name, F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="unique_key"):
        silver.publish_years(spark, typed, root, "t", {"2015": "f"})
    assert silver.current_ledger(spark, root).count() == 0


def test_one_station_opens_one_file_a_year(spark, root):
    b, s = os.path.join(root, "bronze"), os.path.join(root, "silver")
    frame = spark.range(40_000).selectExpr(
        "format_string('%05d', id % 100) AS buoy_id", "concat('s', id % 100) AS source_stem", "CAST(id AS INT) AS line_no",
        "CAST(2015 + id % 2 AS STRING) AS yyyy", "lpad(CAST(1 + id DIV 100 % 12 AS STRING), 2, '0') AS month_raw", "lpad(CAST(1 + id DIV 1200 % 28 AS STRING), 2, '0') AS day_raw",
        "lpad(CAST(id DIV 33600 % 24 AS STRING), 2, '0') AS hour_raw", "'1000.5' AS PRES", "CAST(2015 + id % 2 AS STRING) AS year",
    )
    write_bronze_frame(frame, b)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        run_silver(spark, b, s)
    finally:
        for key in small:
            spark.conf.unset(key)
    whole = silver.read_published_observations(spark, s)
    assert len(whole.inputFiles()) >= 4
    one = silver.read_published_observations(spark, s, buoy_id="00042")
    assert len(one.inputFiles()) <= 2  # a station may stand at a bound
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, whole.where("buoy_id = '00042'").collect())) and one.count()
    month = silver.read_published_observations(spark, s, start=dt.datetime(2015, 3, 1), end=dt.datetime(2015, 4, 1), buoy_id="00044")
    assert len(month.inputFiles()) <= 2 and month.count() == whole.where("buoy_id = '00044' AND datetime >= '2015-03-01' AND datetime < '2015-04-01'").count() > 0
    assert silver.read_published_observations(spark, s, buoy_id="none").count() == 0
