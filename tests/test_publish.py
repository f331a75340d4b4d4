"""Silver load: year snapshots, ledger, incremental skip, run log, health."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests import snippets as S
from tests.conftest import write_text
from tidewater.operators import checks, monitoring
from tidewater.plans.ingest import ingest_station_pages
from tidewater.plans.silver_load import run_silver
from tidewater.schema import OBSERVATION_COLUMNS
from tidewater.sinks import silver
from tidewater.sinks.runs import current_runs, read_run_log, recorded
from tidewater.sources import paths


def _bronze(spark, root):
    b = os.path.join(root, "bronze")
    for buoy, year, text in (
        ("62107", "2016", S.SENTINELS), ("62114", "2016", S.MISFILED), ("62111", "2018", S.WITH_PTDY),
        ("62115", "2015", S.CORRUPT_HOUR), ("62116", "unknown", S.NO_MINUTE),
    ):
        write_text(spark, b, buoy, year, text, stem=f"{buoy}h{year}")
    pages = spark.createDataFrame(
        [
            ("62107", '<div id="stn_metadata"><p><b>a</b><b>b</b><b>c</b><b>12.300 N 45.600 W</b></p></div>'),
            ("62114", '<div id="stn_metadata"><p><b>a</b></p></div>'),
        ],
        "buoy_id string, html string",
    )
    counters = ingest_station_pages(spark, pages, b)
    assert counters["coordinates_missing"] == 1
    return b


def test_load_publish_and_incremental(spark, root):
    bronze_root = _bronze(spark, root)
    silver_root = os.path.join(root, "silver")
    report = run_silver(spark, bronze_root, silver_root)
    assert report.years_loaded == ["2015", "2016", "2018"]
    assert report.unusable_years == ["unknown"]
    assert report.rows == {"2015": (0, 1), "2016": (3, 1), "2018": (1, 0)}
    assert report.coordinates == 2

    obs = silver.read_published_observations(spark, silver_root)
    assert obs.count() == 4
    assert {r["buoy_id"] for r in obs.collect()} == {"62107", "62114", "62111"}
    assert silver.read_published_observations(spark, silver_root, 2015).count() == 0
    coords = {r["buoy_id"]: (r["latitude"], r["longitude"]) for r in silver.read_published_coordinates(spark, silver_root).collect()}
    assert coords == {"62107": (12.3, -45.6), "62114": (None, None)}

    report_checks = checks.integrity_report(obs.withColumn("y", F.year("datetime")), ["buoy_id", "datetime"], ["buoy_id", "datetime"], "datetime", "y")
    assert all(r["violations"] == 0 for r in report_checks.collect())

    # Unchanged bronze: nothing is rebuilt.
    again = run_silver(spark, bronze_root, silver_root)
    assert again.years_loaded == [] and again.years_skipped == ["2015", "2016", "2018"]

    # A rewritten file changes its year's fingerprint: only that year reloads.
    write_text(spark, bronze_root, "62111", "2018", S.NO_MINUTE.replace("2017", "2018"), stem="62111h2018")
    third = run_silver(spark, bronze_root, silver_root)
    assert third.years_loaded == ["2018"]
    latest = silver.read_published_observations(spark, silver_root, 2018).collect()
    assert len(latest) == 1 and latest[0]["datetime"] == dt.datetime(2018, 10, 4, 22, 0)

    forced = run_silver(spark, bronze_root, silver_root, force=True)
    assert forced.years_loaded == ["2015", "2016", "2018"]

    ledger = silver.current_ledger(spark, silver_root)
    rejects = monitoring.rejects_report(ledger).collect()
    assert [r["year"] for r in rejects] == [2015, 2016]
    assert monitoring.partition_count(ledger).collect()[0]["partitions"] == 3

    runs = current_runs(spark, silver_root).collect()
    assert len(runs) == 4 and {r["status"] for r in runs} == {"ok"}
    assert len(read_run_log(spark, silver_root).collect()) == 8


def test_failed_run_is_recorded(spark, root):
    silver_root = os.path.join(root, "silver")
    try:
        run_silver(spark, os.path.join(root, "no-bronze"), silver_root)
    except Exception:
        pass
    runs = current_runs(spark, silver_root).collect()
    assert len(runs) == 1 and runs[0]["status"] == "failed" and runs[0]["error"]


def test_log_that_cannot_be_written_only_warns(spark, root):
    blocker = os.path.join(root, "file")
    open(blocker, "w").close()
    with pytest.warns(UserWarning, match="not written"), recorded(spark, os.path.join(blocker, "sub"), "silver") as run:
        run.figures = {"rows_loaded": 1}


def test_run_states(spark, root):
    with pytest.raises(KeyError), recorded(spark, root, "scrape") as run:
        assert [r["status"] for r in current_runs(spark, root).collect()] == ["running"]
        run.stats = {"when": dt.date(2024, 1, 1)}
        raise KeyError("x\x00" * 5000)
    (row,) = current_runs(spark, root).collect()
    assert row["status"] == "failed" and len(row["error"]) == 4000 and "\x00" not in row["error"]
    assert row["stats"] == '{"when": "2024-01-01"}' and row["finished_at"] >= row["started_at"]
    with recorded(spark, root, "scrape") as run:
        run.problem = "stopped early"
    assert {r["error"] for r in current_runs(spark, root).collect()} == {row["error"], "stopped early"}


def test_interleaved_runs_both_survive(spark, root):
    with recorded(spark, root, "scrape"), recorded(spark, root, "silver"):
        pass
    assert sorted((r["stage"], r["status"]) for r in current_runs(spark, root).collect()) == [("scrape", "ok"), ("silver", "ok")]


def test_unreadable_ledger_raises(spark, root):
    bronze_root, silver_root = _bronze(spark, root), os.path.join(root, "silver")
    run_silver(spark, bronze_root, silver_root)
    folder = os.path.join(silver_root, "_ledger")
    parts = [os.path.join(at, f) for at, _, files in os.walk(folder) for f in files if f.endswith(".parquet")]
    assert parts
    for part in parts:
        with open(part, "wb") as handle:
            handle.write(b"damaged")
    with pytest.raises(Exception, match="(?i)parquet|footer|damaged"):
        silver.read_published_observations(spark, silver_root).count()
    shutil.rmtree(os.path.join(folder, "rows"))
    with pytest.raises(FileNotFoundError, match="lost the rows"):
        silver.read_published_observations(spark, silver_root)


def test_violation_stops_the_publish(spark, root):
    typed = spark.createDataFrame(
        [("1", dt.datetime(2020, 5, 5), "2020")] * 2, "buoy_id string, datetime timestamp_ntz, load_year string"
    ).withColumns({c: F.lit(None).cast("double") for c in OBSERVATION_COLUMNS[2:]})
    with pytest.raises(ValueError, match="unique_key"):
        silver.publish_years(spark, typed, root, "t", {"2020": "f"})
    assert silver.current_ledger(spark, root).count() == 0
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=2)
    assert len(silver.vacuum_snapshots(spark, root, 24, later)) == 2  # the folder of the failed run and its file index


def test_files_follow_the_data_not_the_tasks(spark, root):
    typed = spark.range(0, 40_000, 1, 32).select(
        F.format_string("%05d", F.col("id") % 500).alias("buoy_id"),
        F.make_timestamp_ntz(F.lit(1980) + (F.col("id") % 40).cast("int"), F.lit(1), F.lit(1), (F.col("id") % 24).cast("int"), F.lit(0), (F.col("id") / 1000).cast("decimal(8,6)")).alias("datetime"),
        (F.lit(1980) + F.col("id") % 40).cast("string").alias("load_year"),
        *[F.lit(1.0).alias(c) for c in OBSERVATION_COLUMNS[2:]],
    )
    years = {str(y): "f" for y in range(1980, 2020)}
    rows = silver.publish_years(spark, typed.dropDuplicates(["load_year", "buoy_id", "datetime"]), root, "t", years)
    assert sum(n for n, _ in rows.values()) > 0 and all(bad == 0 for _, bad in rows.values())
    files = [f for _, _, names in os.walk(os.path.join(root, "observations")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 40 + 8


def test_only_the_years_asked_for_are_opened(spark, root):
    bronze_root, silver_root = _bronze(spark, root), os.path.join(root, "silver")
    run_silver(spark, bronze_root, silver_root)
    frame = silver.read_published_observations(spark, silver_root, start=dt.datetime(2016, 9, 21, 18, 30), end=dt.datetime(2017, 1, 1))
    assert {p.split("load_year=")[1][:4] for p in frame.inputFiles()} == {"2016"}
    assert [r["datetime"] for r in frame.collect()] == [dt.datetime(2016, 9, 21, 18, 50)]
    assert sorted(r["datetime"] for r in silver.published_newest(spark, silver_root).collect() if r["datetime"]) == [
        dt.datetime(2016, 9, 21, 18, 50), dt.datetime(2018, 4, 12, 9, 30)
    ]


def test_health_report(spark, root):
    observations = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),)], "datetime timestamp_ntz")
    runs = spark.createDataFrame(
        [
            ("a", "scrape", "failed", dt.datetime(2024, 1, 2)),
            ("b", "scrape", "ok", dt.datetime(2024, 1, 1)),
            ("c", "other", "running", dt.datetime(2024, 1, 1)),
        ],
        "run_token string, stage string, status string, started_at timestamp_ntz",
    )
    ledger = spark.createDataFrame([], "year int")
    problems = monitoring.health_report(spark, observations, runs, ledger, "2024-01-03 00:00:00").orderBy("seq").collect()
    details = [r["detail"] for r in problems]
    assert details == [
        "latest instant lies more than 36 hours back",
        "stage scrape failed in its latest run, begun 2024-01-02 00:00:00",
        "stage silver was never run",
        "unfinished for more than 12 hours",
        "the ledger names no year",
    ]
    healthy = monitoring.health_report(
        spark, observations, runs.where("status = 'ok'").union(runs.where("status='ok'").selectExpr("'d'", "'silver'", "status", "started_at")),
        spark.createDataFrame([(2024,)], "year int"), "2024-01-01 12:00:00",
    )
    assert healthy.count() == 0


def test_superseded_snapshots(spark, root):
    bronze_root = _bronze(spark, root)
    silver_root = os.path.join(root, "silver")
    run_silver(spark, bronze_root, silver_root)
    run_silver(spark, bronze_root, silver_root, force=True)
    old = silver.superseded_snapshots(spark, silver_root).collect()
    # First run's three years and its coordinate snapshot are superseded.
    assert len(old) == 4
    current = {r["path"] for r in silver.current_ledger(spark, silver_root).collect()}
    assert not current & {r["path"] for r in old}


def test_durations_ignore_session_zone(spark):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        runs = spark.createDataFrame(
            [(dt.datetime(2024, 3, 10, 1, 0), dt.datetime(2024, 3, 10, 5, 0))],
            "started_at timestamp_ntz, finished_at timestamp_ntz",
        )
        got = runs.select(monitoring.duration_seconds(F.col("started_at"), F.col("finished_at"))).collect()[0][0]
        assert got == 4 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_published_silver_equals_flagship_query(spark, root):
    """Writing bronze, loading and publishing gives exactly the rows the
    flagship query computes from the same table."""
    from tidewater.plans import derived
    from tidewater.plans.queries import QUERIES
    from tidewater.plans.tables import table
    from tidewater.sinks.bronze import write_bronze_observations

    sf = "/root/testdata/sf0.001"
    bronze_root, silver_root = os.path.join(root, "bronze"), os.path.join(root, "silver")
    write_bronze_observations(derived.station_text_from_events(table(spark, sf, "events")), bronze_root)
    report = run_silver(spark, bronze_root, silver_root)
    published = {tuple(r) for r in silver.read_published_observations(spark, silver_root).collect()}
    expected = {tuple(r) for r in QUERIES["dedup_keep_first"](spark, sf).collect()}
    assert report.rows_loaded == len(expected) and published == expected


def test_vacuum_removes_only_old_superseded_snapshots(spark, root):
    bronze_root = _bronze(spark, root)
    silver_root = os.path.join(root, "silver")
    run_silver(spark, bronze_root, silver_root)
    run_silver(spark, bronze_root, silver_root, force=True)
    assert silver.vacuum_snapshots(spark, silver_root, grace_hours=24) == []
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=2)
    removed = silver.vacuum_snapshots(spark, silver_root, grace_hours=24, now=later)
    # First run: two years with admitted rows and its coordinate snapshot.
    assert len(removed) == 3
    assert all(not paths.exists(spark, p) for p in removed)
    assert silver.read_published_observations(spark, silver_root).count() == 4


@pytest.mark.parametrize("leaves", [KeyboardInterrupt, SystemExit, GeneratorExit, ValueError])
def test_whatever_ends_a_run_early_is_a_failure(spark, root, leaves):
    with pytest.raises(leaves), recorded(spark, root, "scrape"):
        raise leaves
    (row,) = current_runs(spark, root).collect()
    assert (row["status"], leaves.__name__ in row["error"]) == ("failed", True)


@pytest.mark.parametrize("reason, status", [("finished", "ok"), ("shutdown", "failed"), ("closespider_timeout", "failed")])
def test_a_crawl_names_its_finish_reason(spark, root, reason, status):
    with recorded(spark, root, "scrape") as run:
        run.reason = reason
    (row,) = current_runs(spark, root).collect()
    assert row["status"] == status and (row["error"] is None) == (status == "ok")
