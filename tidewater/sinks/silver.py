"""Silver publishing: versioned year snapshots behind an append-only ledger.

Each run writes its years under ``<silver>/observations/run=<token>/`` in ONE
job, checks what it wrote, then appends one ledger row per year. Readers
resolve the current snapshot of every year from the ledger (its highest entry per
year), so a reader sees a year's old snapshot or its new one, never a mix: the
ledger append is the atomic switch. Entries are numbered, and a number is taken
once: a loader that planned on an older state than it finds is refused if a year
of its own has been published since (``LedgerConflict``), and has to plan
again. A crash or a failed check before the append leaves the previous snapshot
current. Old run directories stay until an explicit clean-up.

Beside each run lies an index of its files (range of stations and instants), by
which a read of one station opens only the files that hold it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators import admission, checks, sorted_files
from tidewater.operators.monitoring import latest_per_key
from tidewater.schema import LEDGER, OBSERVATION_COLUMNS, SILVER_COORDINATES, SILVER_OBSERVATIONS
from tidewater.sinks import journal
from tidewater.sources import paths

OBSERVATIONS = "observations"
COORDINATES = "coordinates"


def ledger_path(silver_root: str) -> str:
    return f"{silver_root.rstrip('/')}/_ledger"


class LedgerConflict(RuntimeError):
    """A year was published by another loader after this one had planned."""


def read_ledger(spark: SparkSession, silver_root: str) -> DataFrame:
    """All ledger rows with their entry number (no rows before the first publish)."""
    return journal.read_entries(spark, ledger_path(silver_root), LEDGER)


def ledger_state(spark: SparkSession, silver_root: str) -> int:
    """The newest entry: what a loader has seen before it plans."""
    return journal.newest_entry(spark, ledger_path(silver_root))


def current_ledger(spark: SparkSession, silver_root: str, dataset: str = OBSERVATIONS) -> DataFrame:
    """Latest ledger row per year for ``dataset``."""
    rows = read_ledger(spark, silver_root).where(F.col("dataset") == dataset).drop("dataset")
    return latest_per_key(rows, "year", ["entry"])


def append_ledger(spark: SparkSession, silver_root: str, rows: list[tuple], seen: int | None = None) -> None:
    """Append ledger rows (one per year published: a few dozen at most) as the next entry.

    ``seen``: the state that the rows were made from. Entries since then must not concern the
    same years of the same dataset; without it the append only waits its turn.
    """
    if not rows:
        return
    folder = ledger_path(silver_root)
    own = spark.createDataFrame(rows, LEDGER)
    staged, known = journal.stage(own, folder), ledger_state(spark, silver_root) if seen is None else seen
    while not journal.commit(spark, folder, known + 1, staged):
        newest = ledger_state(spark, silver_root)
        if seen is not None:
            since = read_ledger(spark, silver_root).where((F.col("entry") > known) & (F.col("entry") <= newest))
            named = {(r["dataset"], r["year"]) for r in since.select("dataset", "year").collect()}
            whole = {r["entry"] for r in since.select("entry").distinct().collect()} == set(range(known + 1, newest + 1))
            mine = {(r[LEDGER.fieldNames().index("dataset")], r[LEDGER.fieldNames().index("year")]) for r in rows}
            if not whole or named & mine:
                raise LedgerConflict(f"entries {known + 1} to {newest} published {sorted(named & mine) or 'rows not readable yet'}")
        known = newest


def publish_years(
    spark: SparkSession,
    typed_deduped: DataFrame,
    silver_root: str,
    run_token: str,
    fingerprints: dict[str, str],
    flagged: dict[str, int] | None = None,
    seen: int | None = None,
) -> dict[str, tuple[int, int]]:
    """Write the rows of every year in ``fingerprints`` as new snapshots, check
    them, and point the ledger at them. Returns ``{year: (loaded, rejected)}``.
    ``seen``: the ledger state that the fingerprints were compared with.

    Rows are range-partitioned by (year, station, instant), so a year is a few
    files of adaptive size, each a range of stations, whatever the number of
    tasks. Rejected rows are written beside the admitted ones: the counts come
    from what was written. Two scans follow, neither shuffles rows: one aggregate per year
    (counts, nulls, bounds), and a walk of the sorted keys (repeats, file index).
    """
    years = sorted(fingerprints)
    out = f"{silver_root.rstrip('/')}/{OBSERVATIONS}/run={run_token}"
    scoped = typed_deduped.where(F.col("load_year").isin(years))
    shaped = scoped.select(*OBSERVATION_COLUMNS, "load_year", admission.admissible("load_year").alias("admitted"))
    ranges = shaped.repartitionByRange("load_year", "buoy_id", "datetime")
    # the folder keys lead, so the writer needs no sort of its own that would undo this one
    ranges.sortWithinPartitions("load_year", "admitted", "buoy_id", "datetime").write.mode("errorifexists").partitionBy("load_year", "admitted").parquet(out)
    snapshot = spark.read.schema(f"{_ddl()}, load_year string, admitted boolean").option("basePath", out).parquet(out)
    admitted = F.col("admitted")
    wrong = checks.outside_year(F.col("datetime"), F.col("load_year"))
    counted = {
        r["load_year"]: r
        for r in snapshot.groupBy("load_year").agg(
            F.count_if(admitted).alias("rows_loaded"),
            F.count_if(~admitted).alias("rows_rejected"),
            F.max(F.when(admitted, F.col("datetime"))).alias("newest"),
            F.count_if(admitted & (F.col("buoy_id").isNull() | F.col("datetime").isNull())).alias("not_null"),
            F.count_if(admitted & wrong).alias("in_year_range"),
        ).collect()
    }
    checks.assert_none({c: sum(r[c] for r in counted.values()) for c in ("not_null", "in_year_range")})
    index = index_path(silver_root, run_token)
    sorted_files.stretches(snapshot.where("admitted")).write.mode("errorifexists").parquet(index)
    checks.assert_clean(sorted_files.neighbour_check(spark.read.parquet(index)))
    now = dt.datetime.now(dt.timezone.utc)
    result, rows = {}, []
    for y in years:
        found = counted.get(y)
        loaded, rejected = (found["rows_loaded"], found["rows_rejected"]) if found else (0, 0)
        result[y] = (loaded, rejected)
        newest = found["newest"] if found else None
        rows.append((int(y), fingerprints[y], loaded, rejected, (flagged or {}).get(y, 0), newest, now, f"{out}/load_year={y}/admitted=true", run_token, OBSERVATIONS))
    append_ledger(spark, silver_root, rows, seen)
    return result


def index_path(silver_root: str, run_token: str) -> str:
    return f"{silver_root.rstrip('/')}/{OBSERVATIONS}_index/run={run_token}"


def _ddl() -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SILVER_OBSERVATIONS.fields)


def publish_coordinates(spark: SparkSession, coordinates: DataFrame, silver_root: str, run_token: str) -> int:
    """New dimension snapshot + pointer row; readers never see it empty."""
    out = f"{silver_root.rstrip('/')}/{COORDINATES}/run={run_token}"
    coordinates.select(*SILVER_COORDINATES.fieldNames()).write.mode("errorifexists").parquet(out)
    n = admission.dimension_count(spark.read.schema(SILVER_COORDINATES).parquet(out)).first()["stations"]
    append_ledger(spark, silver_root, [(0, "", n, 0, 0, None, dt.datetime.now(dt.timezone.utc), out, run_token, COORDINATES)])
    return n


def read_published_observations(
    spark: SparkSession,
    silver_root: str,
    year: int | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    buoy_id: str | None = None,
) -> DataFrame:
    """Current snapshot of every published year, of one year, or of the
    instants in ``[start, end)``: only the years that can hold them are opened. With
    ``buoy_id`` only the files are opened whose range of stations (and instants) can hold it.

    Only the pointers (one per year, or one per chosen file) reach the driver; the data is
    read by the executors. A pointer whose files are gone raises, unless its year
    admitted no row at all.
    """
    cur = current_ledger(spark, silver_root)
    if year is not None:
        cur = cur.where(F.col("year") == int(year))
    if start is not None:
        cur = cur.where(F.col("year") >= start.year)
    if end is not None:
        last = end - dt.timedelta(microseconds=1)
        cur = cur.where(F.col("year") <= last.year)
    pointers = cur.select("path", "rows_loaded", "run_token").collect()
    held = [r["path"] for r in pointers if r["rows_loaded"] or paths.exists(spark, r["path"])]
    if buoy_id is not None and held:
        held = _files_of_station(spark, silver_root, [r for r in pointers if r["path"] in set(held)], buoy_id, start, end)
    if not held:
        return spark.createDataFrame([], SILVER_OBSERVATIONS)
    rows = spark.read.schema(SILVER_OBSERVATIONS).parquet(*held).select(*OBSERVATION_COLUMNS)
    if buoy_id is not None:
        rows = rows.where(F.col("buoy_id") == buoy_id)
    if start is not None:
        rows = rows.where(F.col("datetime") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        rows = rows.where(F.col("datetime") < F.lit(end).cast("timestamp_ntz"))
    return rows


def _files_of_station(spark: SparkSession, silver_root: str, pointers: list, buoy_id: str, start, end) -> list[str]:
    """Files of the current snapshots that can hold rows of the station within the instants."""
    indexes = sorted({index_path(silver_root, r["run_token"]) for r in pointers})
    folders = spark.createDataFrame([(r["path"].rsplit("/run=", 1)[1],) for r in pointers], "folder string")
    files = sorted_files.file_index(spark.read.parquet(*indexes)).where((F.col("first_buoy") <= buoy_id) & (F.col("last_buoy") >= buoy_id))
    if start is not None:
        files = files.where(F.col("last_datetime") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        files = files.where(F.col("first_datetime") < F.lit(end).cast("timestamp_ntz"))
    own = F.regexp_extract("file", r"^.*/run=(.*)/[^/]*$", 1).alias("folder")
    return [r["file"] for r in files.select("file", own).join(F.broadcast(folders), "folder", "left_semi").select("file").collect()]


def published_newest(spark: SparkSession, silver_root: str) -> DataFrame:
    """(datetime) newest instant of each published year, from the ledger: what a
    freshness check needs, without opening the fact."""
    return current_ledger(spark, silver_root).select(F.col("max_datetime").alias("datetime"))


def read_published_coordinates(spark: SparkSession, silver_root: str) -> DataFrame:
    cur = current_ledger(spark, silver_root, COORDINATES)
    held = [r["path"] for r in cur.select("path").collect()]
    if not held:
        return spark.createDataFrame([], SILVER_COORDINATES)
    return spark.read.schema(SILVER_COORDINATES).parquet(*held)


def superseded_snapshots(spark: SparkSession, silver_root: str) -> DataFrame:
    """Snapshots no reader resolves any more, with the time they were replaced
    (the next ledger row of their dataset and year)."""
    order = Window.partitionBy("dataset", "year").orderBy("entry")
    rows = read_ledger(spark, silver_root).withColumn("replaced_at", F.lead("loaded_at").over(order))
    return rows.where("replaced_at is not null").select("dataset", "year", "path", "run_token", "replaced_at")


def vacuum_snapshots(spark: SparkSession, silver_root: str, grace_hours: float = 24.0, now=None) -> list[str]:
    """Delete snapshots replaced more than ``grace_hours`` ago, and folders of
    runs that old which never reached the ledger (crashed or failed their
    checks). The ledger rows stay as history. Returns the removed paths.

    The ledger is small (one row per year per load): only paths reach the driver.
    """
    cutoff = (now or dt.datetime.now(dt.timezone.utc)) - dt.timedelta(hours=grace_hours)
    old = superseded_snapshots(spark, silver_root).where(F.col("replaced_at") < F.lit(cutoff))
    removed = sorted({r["path"] for r in old.select("path").collect() if paths.exists(spark, r["path"])})
    known = {r["run_token"] for r in read_ledger(spark, silver_root).select("run_token").distinct().collect()}
    for dataset in (OBSERVATIONS, COORDINATES, f"{OBSERVATIONS}_index"):
        base = f"{silver_root.rstrip('/')}/{dataset}"
        for name, changed in paths.children(spark, base):
            if name.startswith("run=") and name.removeprefix("run=") not in known and changed / 1000 < cutoff.timestamp():
                removed.append(f"{base}/{name}")
    for path in removed:
        paths.delete(spark, path)
    return removed


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append to an external serving database. Spark's JDBC writer inserts
    by column name, so column order cannot corrupt the load."""
    df.write.jdbc(url, table, mode="append", properties=properties or {})
