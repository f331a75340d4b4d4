"""Command line: ``python -m tidewater <command> ...``.

    plan    --index <parquet of url, html> --bronze <dir> --out <dir> [--year <yyyy>] [--full-refresh]
    ingest  --landed <dir> --bronze <dir> [--pages <parquet of buoy_id, html>] [--silver <dir>]
            [--finish-reason <why the crawl that fetched the files ended>]
    convert --legacy <dir> --bronze <dir>
    silver  --bronze <dir> --silver <dir> [--force]
    health  --silver <dir> [--as-of "YYYY-MM-DD HH:MM:SS"]
    vacuum  [--silver <dir>] [--bronze <dir>] [--grace-hours 24]

``ingest --silver`` records the ingest as a ``scrape`` run in the log that
``health`` reads. The session comes from ``spark-submit`` / the environment
(master, memory, ``spark.checkpoint.dir``); the engine's own settings are
applied on top. ``health`` exits 1 when any problem is reported, 0 otherwise.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from tidewater.operators.monitoring import FINISHED
from tidewater.session import configure


def _health(spark: SparkSession, silver_root: str, as_of: str | None) -> int:
    from tidewater.operators.monitoring import health_report
    from tidewater.sinks.runs import current_runs
    from tidewater.sinks.silver import current_ledger, published_newest

    when = as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    problems = health_report(
        spark,
        published_newest(spark, silver_root),
        current_runs(spark, silver_root),
        current_ledger(spark, silver_root),
        when,
    ).orderBy("seq").collect()
    if not problems:
        print("HEALTHY")
        return 0
    for p in problems:
        print(f"UNHEALTHY: {p['check']}: {p['detail']}")
    return 1


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidewater")
    sub = parser.add_subparsers(dest="command", required=True)
    ingest = sub.add_parser("ingest")
    ingest.add_argument("--landed", required=True)
    ingest.add_argument("--bronze", required=True)
    ingest.add_argument("--pages")
    ingest.add_argument("--silver")
    ingest.add_argument("--finish-reason", default=FINISHED)
    plan = sub.add_parser("plan")
    for name in ("--index", "--bronze", "--out"):
        plan.add_argument(name, required=True)
    plan.add_argument("--year", type=int, default=dt.datetime.now(dt.timezone.utc).year)
    plan.add_argument("--full-refresh", action="store_true")
    convert = sub.add_parser("convert")
    convert.add_argument("--legacy", required=True)
    convert.add_argument("--bronze", required=True)
    silver = sub.add_parser("silver")
    silver.add_argument("--bronze", required=True)
    silver.add_argument("--silver", required=True)
    silver.add_argument("--force", action="store_true")
    vacuum = sub.add_parser("vacuum")
    vacuum.add_argument("--silver")
    vacuum.add_argument("--bronze")
    vacuum.add_argument("--grace-hours", type=float, default=24.0)
    health = sub.add_parser("health")
    health.add_argument("--silver", required=True)
    health.add_argument("--as-of")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"tidewater-{args.command}").getOrCreate())
    if args.command == "plan":
        from tidewater.plans.ingest import plan_fetch

        todo = plan_fetch(spark, spark.read.parquet(args.index), args.bronze, args.year, args.full_refresh)
        todo.write.mode("errorifexists").parquet(args.out)
        return 0
    if args.command == "ingest":
        from tidewater.plans.ingest import ingest_landed_files, ingest_station_pages
        from tidewater.sinks.runs import recorded

        with recorded(spark, args.silver, "scrape") as run:
            out = {"observations": ingest_landed_files(spark, args.landed, args.bronze)}
            if args.pages:
                out["coordinates"] = ingest_station_pages(spark, spark.read.parquet(args.pages), args.bronze)
            run.reason = args.finish_reason
            run.figures, run.stats = {"rows_loaded": out["observations"]["rows_written"]}, out
        print(json.dumps(out))
        return 0
    if args.command == "convert":
        from tidewater.sources.legacy import convert_legacy_bronze

        print(json.dumps(convert_legacy_bronze(spark, args.legacy, args.bronze)))
        return 0
    if args.command == "silver":
        from tidewater.plans.silver_load import run_silver

        report = run_silver(spark, args.bronze, args.silver, force=args.force)
        years = {y: {"loaded": n, "rejected": bad, "flagged": report.flagged.get(y, 0)} for y, (n, bad) in report.rows.items()}
        print(json.dumps({"years": years, "unchanged": report.years_skipped, "not_a_year": report.unusable_years, "stations": report.coordinates}))
        return 0
    if args.command == "vacuum":
        from tidewater.sinks.silver import vacuum_snapshots
        from tidewater.sources.bronze import vacuum_bronze

        removed = vacuum_snapshots(spark, args.silver, args.grace_hours) if args.silver else []
        removed += vacuum_bronze(spark, args.bronze, args.grace_hours) if args.bronze else []
        print(json.dumps({"removed": removed}))
        return 0
    return _health(spark, args.silver, args.as_of)


if __name__ == "__main__":
    sys.exit(main())
