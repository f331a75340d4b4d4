"""Silver load: discover -> change detection -> transform -> publish.

All changed years are rebuilt in ONE Spark job (the dedup key carries the
load year, so results equal a year-at-a-time load); only small metadata
(years, fingerprints, ledger pointers, counters) reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidewater.operators import incremental
from tidewater.operators import observations as obs
from tidewater.session import configure
from tidewater.sinks import silver as publish
from tidewater.sinks.runs import recorded
from tidewater.sources import bronze


@dataclass
class LoadReport:
    """What a load did, year by year."""

    rows: dict[str, tuple[int, int]] = field(default_factory=dict)  # loaded, rejected
    flagged: dict[str, int] = field(default_factory=dict)
    years_skipped: list[str] = field(default_factory=list)
    unusable_years: list[str] = field(default_factory=list)
    coordinates: int = 0
    run_token: str = ""

    @property
    def years_loaded(self) -> list[str]:
        return sorted(self.rows)

    def figures(self) -> dict[str, int]:
        loaded, rejected = (sum(v[k] for v in self.rows.values()) for k in (0, 1))
        return {"rows_loaded": loaded, "years_loaded": len(self.rows), "rows_rejected": rejected}

    @property
    def rows_loaded(self) -> int:
        return self.figures()["rows_loaded"]

    @property
    def rows_rejected(self) -> int:
        return self.figures()["rows_rejected"]


def plan_years(spark: SparkSession, bronze_root: str, silver_root: str, force: bool = False, batches: list[str] | None = None):
    """(years to load with their fingerprints, unchanged years, unusable
    years), as of the committed ``batches``: files of an ingest that is still
    running count neither here nor in the read."""
    batches = bronze.committed_batches(spark, bronze_root) if batches is None else batches
    if not batches:
        return {}, [], []
    current = incremental.committed_fingerprints(bronze.read_manifests(spark, bronze_root, batches=batches))
    found = current.withColumn("usable", incremental.is_loadable_year()).select("year", "bronze_fingerprint", "usable").collect()
    unusable = sorted(r["year"] for r in found if not r["usable"])
    # one row per year from here on
    listed = spark.createDataFrame([(r["year"], r["bronze_fingerprint"]) for r in found if r["usable"]], "year string, bronze_fingerprint string")
    changed = incremental.changed_years(listed, publish.current_ledger(spark, silver_root), force=force)
    to_load = {r["year"]: r["bronze_fingerprint"] for r in changed.collect()}
    return to_load, sorted(r["year"] for r in found if r["usable"] and r["year"] not in to_load), unusable


#: Plans of one load before it gives up against loaders that publish the same years.
ATTEMPTS = 5


def run_silver(
    spark: SparkSession, bronze_root: str, silver_root: str, force: bool = False, track: bool = True
) -> LoadReport:
    """Rebuild every changed year and the station dimension.

    The ledger state is read before the committed batches are listed; if another loader
    publishes one of the same years meanwhile, the load plans again (and
    skips the years that are up to date by then).
    """
    configure(spark)
    report = LoadReport()
    with recorded(spark, silver_root if track else None, "silver") as run:
        report.run_token = run.token
        for attempt in range(ATTEMPTS):
            seen = publish.ledger_state(spark, silver_root)
            batches = bronze.committed_batches(spark, bronze_root)
            to_load, report.years_skipped, report.unusable_years = plan_years(spark, bronze_root, silver_root, force, batches)
            run.stats = {"unusable_years": report.unusable_years, "skipped": report.years_skipped}
            if not to_load and not report.years_skipped:
                raise FileNotFoundError(f"{bronze_root} holds no year of observations")
            report.rows, report.flagged = {}, {}
            if not to_load:
                break
            raw = bronze.read_bronze_observations(spark, bronze_root, years=list(to_load), batches=batches)
            typed = obs.dedup_keep_first(obs.normalize(raw), ["load_year"])
            report.flagged = bronze.flagged_lines(spark, bronze_root, list(to_load), batches)
            token = run.token if not attempt else f"{run.token}-{attempt}"
            try:
                report.rows = publish.publish_years(spark, typed, silver_root, token, to_load, report.flagged, seen)
                break
            except publish.LedgerConflict:
                if attempt == ATTEMPTS - 1:
                    raise
        run.figures = report.figures()
        if bronze.has_dataset(spark, bronze_root, "coordinates"):
            positions = bronze.read_coordinates(spark, bronze_root)
            report.coordinates = publish.publish_coordinates(spark, positions, silver_root, run.token)
        # else: no station pages landed yet; the published dimension (if any) stays.
    return report
