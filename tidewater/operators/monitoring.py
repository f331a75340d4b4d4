"""Run log and ledger views, freshness and the health report.

Operational tables (run log, ledger) are small: one row per run or per
year loaded. The fact-table probe (freshness) is one partial aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.schema import ERROR_CLIP_CHARS, MAX_AGE_HOURS, STAGES, STALE_RUN_HOURS

#: Fixed value: the reason of a run that came to its end.
FINISHED = "finished"


def _ts(value: dt.datetime | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp_ntz")


def _micros_between(earlier: Column, later: Column) -> Column:
    # Exact for zone-less timestamps whatever the session zone (a cast to a
    # zoned timestamp would lose or gain an hour across a DST change).
    return F.timestamp_diff("MICROSECOND", earlier, later)


def hours_between(later: Column, earlier: Column) -> Column:
    """(later - earlier) in hours, from exact microseconds."""
    return _micros_between(earlier, later) / F.lit(3.6e9)


def duration_seconds(started: Column, finished: Column) -> Column:
    """finished - started in seconds; NULL while still running."""
    return _micros_between(started, finished) / F.lit(1e6)


def freshness(observations: DataFrame, as_of, ts_col: str = "datetime", max_age_hours: float = MAX_AGE_HOURS) -> DataFrame:
    """One row: newest instant, its age in hours at ``as_of`` (NULL when the
    table is empty) and whether that exceeds the threshold (strictly)."""
    newest = observations.agg(F.max(ts_col).alias("newest"))
    age = hours_between(_ts(as_of), F.col("newest"))
    return newest.select(
        "newest",
        age.alias("age_hours"),
        F.coalesce(age > F.lit(max_age_hours), F.lit(True)).alias("is_stale"),
    )


def latest_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per ``key`` (later columns
    break ties). ``max_by`` is a partial aggregate: each task ships one row
    per key. Meant for the small run-log and ledger tables."""
    others = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*others), F.struct(*order_cols)).alias("_latest"))
        .select(key, "_latest.*")
    )


def latest_run_per_stage(runs: DataFrame) -> DataFrame:
    """Latest row per stage by ``started_at`` (run token breaks ties)."""
    return latest_per_key(runs, "stage", ["started_at", "run_token"])


def latest_run_rows(run_log: DataFrame) -> DataFrame:
    """The run log is append-only (a start row, then a finish row); the
    current state of a run is its latest row by ``recorded_at``."""
    return latest_per_key(run_log, "run_token", ["recorded_at"])


def is_stuck(as_of, stale_hours: float = STALE_RUN_HOURS) -> Column:
    """Still ``running`` and started more than ``stale_hours`` before ``as_of``."""
    age = _micros_between(F.col("started_at"), _ts(as_of))
    return (F.col("status") == "running") & (age > F.lit(int(stale_hours * 3_600_000_000)))


def stuck_runs(runs: DataFrame, as_of, stale_hours: float = STALE_RUN_HOURS) -> DataFrame:
    """Runs still ``running`` that started more than ``stale_hours`` ago."""
    return runs.where(is_stuck(as_of, stale_hours))


def last_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` runs with duration (a top-k: per-task top-n, then merge)."""
    return (
        runs.select(
            "run_token", "stage", "status", "started_at", "finished_at",
            duration_seconds(F.col("started_at"), F.col("finished_at")).alias("duration_sec"),
            "rows_loaded", "years_loaded", "rows_rejected",
        )
        .orderBy(F.col("started_at").desc(), F.col("run_token").desc())
        .limit(n)
    )


def ledger_latest(ledger: DataFrame) -> DataFrame:
    """Current row per year of the append-only ledger (newest ``loaded_at``)."""
    return latest_per_key(ledger, "year", ["loaded_at", "run_token"])


def rejects_report(ledger_current: DataFrame) -> DataFrame:
    """Years that rejected rows, in year order."""
    return ledger_current.where(F.col("rows_rejected") > 0).select(
        "year", "rows_loaded", "rows_rejected", "loaded_at"
    ).orderBy("year")


def run_counters(ledger: DataFrame) -> DataFrame:
    """Per run: rows loaded, rows rejected, years loaded."""
    return ledger.groupBy("run_token").agg(
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("rows_rejected").alias("rows_rejected"),
        F.count(F.lit(1)).alias("years_loaded"),
    )


def partition_count(ledger_current: DataFrame) -> DataFrame:
    return ledger_current.agg(F.countDistinct("year").alias("partitions"))


def run_status_from_reason(reason: Column) -> Column:
    """A run is ``ok`` only when it finished normally."""
    return F.when(reason == FINISHED, F.lit("ok")).otherwise(F.lit("failed"))


def clip_error(text: Column) -> Column:
    """NUL bytes removed, first 4,000 characters kept."""
    return F.substring(F.replace(text, F.lit("\u0000"), F.lit("")), 1, ERROR_CLIP_CHARS)


def stats_json(stats: Column) -> Column:
    """Map of stats (values as text) -> JSON text."""
    return F.to_json(stats)


def health_report(
    spark: SparkSession,
    observations: DataFrame,
    runs: DataFrame,
    ledger_current: DataFrame,
    as_of,
    ts_col: str = "datetime",
    stages: tuple[str, ...] = STAGES,
    max_age_hours: float = MAX_AGE_HOURS,
    stale_hours: float = STALE_RUN_HOURS,
) -> DataFrame:
    """One row per problem ``(seq, check, detail, value)``; healthy means
    empty. ``value`` carries the measured figure (age in hours, count).

    Order of checks: freshness, last run per stage (never run / failed),
    stuck runs, attached partitions. Each check is a small aggregate; the
    union is evaluated as one job.
    """
    fresh = freshness(observations, as_of, ts_col, max_age_hours)
    p_fresh = fresh.select(
        F.lit(1).alias("seq"),
        F.lit("FRESHNESS").alias("check"),
        F.when(F.col("newest").isNull(), F.lit("no observation is published"))
        .when(
            F.col("age_hours") > F.lit(max_age_hours),
            F.format_string("latest instant lies more than %d hours back", F.lit(int(max_age_hours))),
        )
        .alias("detail"),
        F.col("age_hours").alias("value"),
    )
    # One pass over the run log: latest run and stuck count per stage. The
    # two consumers below read the same aggregate (its exchange is reused).
    per_stage = runs.groupBy("stage").agg(
        F.max_by(F.struct("run_token", "status", "started_at"), F.struct("started_at", "run_token")).alias("_latest"),
        F.count_if(is_stuck(as_of, stale_hours)).alias("_stuck"),
    )
    wanted = spark.createDataFrame([(s,) for s in stages], "stage string")
    latest = per_stage.select("stage", "_latest.*")
    p_runs = wanted.join(latest, "stage", "left").select(
        F.lit(2).alias("seq"),
        F.lit("RUNS").alias("check"),
        F.when(F.col("run_token").isNull(), F.format_string("stage %s was never run", F.col("stage")))
        .when(
            F.col("status") == "failed",
            F.concat(
                F.lit("stage "), F.col("stage"), F.lit(" failed in its latest run, begun "),
                F.date_format(F.col("started_at"), "yyyy-MM-dd HH:mm:ss"),
            ),
        )
        .alias("detail"),
        F.lit(None).cast("double").alias("value"),
    )
    stuck = per_stage.agg(F.coalesce(F.sum("_stuck"), F.lit(0)).alias("n"))
    p_stuck = stuck.select(
        F.lit(3).alias("seq"),
        F.lit("RUNS").alias("check"),
        F.when(
            F.col("n") > 0,
            F.format_string("unfinished for more than %d hours", F.lit(int(stale_hours))),
        ).alias("detail"),
        F.col("n").cast("double").alias("value"),
    )
    p_parts = partition_count(ledger_current).select(
        F.lit(4).alias("seq"),
        F.lit("SCHEMA").alias("check"),
        F.when(F.col("partitions") == 0, F.lit("the ledger names no year")).alias("detail"),
        F.col("partitions").cast("double").alias("value"),
    )
    return p_fresh.unionByName(p_runs).unionByName(p_stuck).unionByName(p_parts).where(F.col("detail").isNotNull())
