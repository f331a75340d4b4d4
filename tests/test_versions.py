"""Bronze versions: commits decide what counts, manifests choose the files, clean-up."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import incremental
from tidewater.plans.silver_load import plan_years, run_silver
from tidewater.sinks import silver
from tidewater.sinks.bronze import write_bronze_frame
from tidewater.sources import bronze, paths

COLUMNS = "buoy_id string, source_stem string, line_no int, yyyy string, month_raw string, day_raw string, hour_raw string, PRES string, year string"


def rows(spark, *sources, year="2015", hours=1, pressure="1000.5"):
    return spark.createDataFrame([(s, f"{s}h{year}", k + 1, year, "01", "02", f"{k:02d}", pressure, year) for s in sources for k in range(hours)], COLUMNS)


def test_rows_of_an_ingest_in_flight_are_loaded_after_its_commit(spark, root, monkeypatch):
    """The files of a second batch stand, its manifest doesn't: a load then must not count them,
    and the load after the commit must take them."""
    b, s = os.path.join(root, "bronze"), os.path.join(root, "silver")
    write_bronze_frame(rows(spark, "1"), b)
    running = "9" * 20 + "-late"
    rows(spark, "2", "3").withColumn("extra", F.lit(None).cast("map<string,string>")).write.partitionBy("year").parquet(f"{bronze.observations_path(b)}/batch={running}")
    first = run_silver(spark, b, s)
    assert first.rows == {"2015": (1, 0)}
    manifest = spark.createDataFrame([("2", "2h2015", "2015", 0), ("3", "3h2015", "2015", 0)], "buoy_id string, source_stem string, year string, lines_flagged bigint")
    manifest.write.parquet(f"{bronze.manifests_path(b)}/batch={running}")
    assert run_silver(spark, b, s).rows == {"2015": (3, 0)}
    third = run_silver(spark, b, s)
    assert third.rows == {} and third.years_skipped == ["2015"]


def test_a_batch_committed_between_plan_and_read_waits(spark, root):
    b, s = os.path.join(root, "bronze"), os.path.join(root, "silver")
    write_bronze_frame(rows(spark, "1"), b)
    batches = bronze.committed_batches(spark, b)
    plan, _, _ = plan_years(spark, b, s, batches=batches)
    write_bronze_frame(rows(spark, "1", "2"), b)
    held = bronze.read_bronze_observations(spark, b, years=["2015"], batches=batches)
    assert held.count() == 1
    later, _, _ = plan_years(spark, b, s)
    assert set(plan) == set(later) and plan != later


def test_fingerprints_change_with_commits_only(spark, root):
    of = lambda: {r["year"]: r["bronze_fingerprint"] for r in incremental.committed_fingerprints(bronze.read_manifests(spark, root)).collect()}
    write_bronze_frame(rows(spark, "1", "2"), root)
    write_bronze_frame(rows(spark, "5", year="2016"), root)
    one = of()
    write_bronze_frame(rows(spark, "2"), root)
    two = of()
    assert one["2016"] == two["2016"] and one["2015"] != two["2015"] and two["2015"].startswith("2:")
    write_bronze_frame(rows(spark, "1"), root)
    three = of()
    bronze.vacuum_bronze(spark, root, grace_hours=0, now=dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1))
    assert of() == three


def test_a_source_fetched_thirty_times_opens_its_last_files_only(spark, root):
    write_bronze_frame(rows(spark, "1", "2", "3", year="2014"), root)
    for _ in range(30):
        write_bronze_frame(rows(spark, "7", "8", year="2015"), root)
    current = bronze.read_bronze_observations(spark, root)
    assert "Join" not in current._jdf.queryExecution().executedPlan().toString()
    newest = bronze.committed_batches(spark, root)[-1]
    assert len(current.inputFiles()) == 2 and sum(f"batch={newest}" in f for f in current.inputFiles()) == 1
    assert current.count() == 5


def test_mixed_folders_drop_replaced_rows_and_others_stay_plain(spark, root):
    write_bronze_frame(rows(spark, "1", "2", hours=3), root)
    write_bronze_frame(rows(spark, "2", hours=1, pressure="999.0"), root)
    write_bronze_frame(rows(spark, "3", year="unknown"), root)
    got = sorted((r.buoy_id, r.PRES, r.year) for r in bronze.read_bronze_observations(spark, root).collect())
    assert got == [("1", "1000.5", "2015")] * 3 + [("2", "999.0", "2015"), ("3", "1000.5", "unknown")]
    folders = {(r["year"], r["sources"], r["current"]) for r in bronze.version_folders(bronze.read_manifests(spark, root)).collect()}
    assert folders == {("2015", 2, 1), ("2015", 1, 1), ("unknown", 1, 1)}
    assert bronze.read_bronze_observations(spark, root, year="1999").count() == 0


@pytest.mark.parametrize("year", ["a=b", "x/y:z", "50%", "é"])
def test_odd_year_texts_keep_their_folder(spark, root, year):
    write_bronze_frame(rows(spark, "1", year=year), root)
    write_bronze_frame(rows(spark, "2", year=year), root)
    assert {r.year for r in bronze.read_bronze_observations(spark, root).collect()} == {year}


def test_vacuum_waits_for_the_grace_period_and_keeps_readers_right(spark, root):
    write_bronze_frame(rows(spark, "1", "2"), root)
    write_bronze_frame(rows(spark, "1", "2", "3"), root)
    write_bronze_frame(rows(spark, "3"), root)
    paths.create_text(spark, f"{bronze.observations_path(root)}/batch=00-dead/year=2015/part", "x")
    before = bronze.read_bronze_observations(spark, root)
    held = sorted(map(tuple, before.select("buoy_id", "batch").collect()))
    assert bronze.vacuum_bronze(spark, root) == []
    gone = bronze.vacuum_bronze(spark, root, now=dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=25))
    assert len(gone) == 2 and gone[0].endswith("batch=00-dead") and gone[1].endswith("year=2015")
    after = bronze.read_bronze_observations(spark, root)
    assert sorted(map(tuple, after.select("buoy_id", "batch").collect())) == held
    assert bronze.vacuum_bronze(spark, root, now=dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=25)) == []


def test_file_counts_follow_bytes_not_tasks(spark, root):
    """48 years over 64 tasks: files by the size target; a large year is cut."""
    spread = spark.range(64 * 48, numPartitions=64).selectExpr(
        "CAST(id % 7 AS STRING) AS buoy_id", "concat('s', id % 7) AS source_stem", "CAST(id AS INT) AS line_no", "CAST(1970 + id % 48 AS STRING) AS year"
    )
    write_bronze_frame(spread, root)
    files = bronze.bronze_inventory(spark, root)
    assert files.count() <= 48 + 8 and files.select("year").distinct().count() == 48
    skewed = spark.range(400_000, numPartitions=32).selectExpr(
        "CAST(id % 7 AS STRING) AS buoy_id", "concat('s', id % 7) AS source_stem", "CAST(id AS INT) AS line_no", "sha2(CAST(id AS STRING), 256) AS PRES", "CASE WHEN id % 100 = 0 THEN '2001' ELSE '2002' END AS year"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    try:
        write_bronze_frame(skewed, root + "2")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    counts = {r["year"]: r["count"] for r in bronze.bronze_inventory(spark, root + "2").groupBy("year").count().collect()}
    assert counts["2002"] >= 4 and sum(counts.values()) < 32  # 32 tasks held both years


def test_two_loads_at_once_undo_nothing(spark, root, monkeypatch):
    """Loader A plans; loader B loads a newer bronze meanwhile; A's append is refused, and A plans again."""
    b, s = os.path.join(root, "bronze"), os.path.join(root, "silver")
    write_bronze_frame(rows(spark, "1"), b)
    publish, calls = silver.publish_years, []

    def interrupted(*args, **kwargs):
        calls.append(1)
        if len(calls) == 1:
            write_bronze_frame(rows(spark, "1", "2", "3"), b)
            run_silver(spark, b, s)  # loader B, whole
        return publish(*args, **kwargs)

    monkeypatch.setattr(silver, "publish_years", interrupted)
    report = run_silver(spark, b, s)
    assert report.rows == {} and report.years_skipped == ["2015"]
    assert silver.read_published_observations(spark, s).count() == 3
    assert [r["rows_loaded"] for r in silver.current_ledger(spark, s).collect()] == [3]


def test_loads_of_other_years_only_wait_their_turn(spark, root):
    row = lambda y, run: (y, "f", 1, 0, 0, None, dt.datetime(2020, 1, 1), f"/p/{run}", run, silver.OBSERVATIONS)
    silver.append_ledger(spark, root, [row(2001, "a")], seen=0)
    silver.append_ledger(spark, root, [row(2002, "b")], seen=0)
    with pytest.raises(silver.LedgerConflict):
        silver.append_ledger(spark, root, [row(2002, "c")], seen=1)
    silver.append_ledger(spark, root, [row(2002, "d")], seen=2)
    current = {r["year"]: (r["run_token"], r["entry"]) for r in silver.current_ledger(spark, root).collect()}
    assert current == {2001: ("a", 1), 2002: ("d", 3)}


def test_the_older_clock_does_not_win(spark, root):
    late = (2001, "f", 1, 0, 0, None, dt.datetime(2030, 1, 1), "/p/a", "a", silver.OBSERVATIONS)
    early = (2001, "f", 2, 0, 0, None, dt.datetime(2020, 1, 1), "/p/b", "b", silver.OBSERVATIONS)
    silver.append_ledger(spark, root, [late])
    silver.append_ledger(spark, root, [early])
    assert [r["run_token"] for r in silver.current_ledger(spark, root).collect()] == ["b"]


def test_a_number_taken_by_a_dead_writer_is_passed(spark, root):
    paths.create_text(spark, f"{silver.ledger_path(root)}/commits/000000000001", "")
    row = (2001, "f", 1, 0, 0, None, dt.datetime(2020, 1, 1), "/p/a", "a", silver.OBSERVATIONS)
    with pytest.raises(silver.LedgerConflict):
        silver.append_ledger(spark, root, [row], seen=0)
    silver.append_ledger(spark, root, [row], seen=silver.ledger_state(spark, root))
    assert [r["entry"] for r in silver.current_ledger(spark, root).collect()] == [2]
