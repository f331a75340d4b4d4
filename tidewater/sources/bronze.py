"""Bronze scans: observations, coordinates, file inventory, footer probe.

Bronze layout (written by ``tidewater.sinks.bronze``)::

    <root>/observations/batch=<ingest id>/year=<yyyy|unknown>/*.parquet
    <root>/manifests/batch=<ingest id>/*.parquet     (one row per source; commits the batch)
    <root>/coordinates/batch=<ingest id>/*.parquet

Every partition value is text: the session turns partition type inference
off, and the readers pass explicit schemas, so ``0041`` stays ``0041``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators import observations as obs
from tidewater.operators.stations import collapse_coordinates
from tidewater.schema import BRONZE_COORDINATES, BRONZE_OBSERVATIONS
from tidewater.sources import paths

SOURCE_KEY = ["year", "buoy_id", "source_stem"]
_MANIFEST = "buoy_id string, source_stem string, year string, lines_flagged bigint, batch string"
#: Superseded source versions (a few short texts each) that are sent to the
#: tasks; beyond that count the anti-join is left to the planner.
BROADCAST_VERSIONS = 200_000


def observations_path(root: str) -> str:
    return f"{root.rstrip('/')}/observations"


def manifests_path(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def coordinates_path(root: str) -> str:
    return f"{root.rstrip('/')}/coordinates"


def has_dataset(spark: SparkSession, root: str, dataset: str) -> bool:
    """Whether ``<root>/<dataset>`` exists (file-system metadata only)."""
    return paths.exists(spark, f"{root.rstrip('/')}/{dataset}")


def committed_batches(spark: SparkSession, root: str) -> list[str]:
    """Names of the committed batches, oldest first. A job that reads bronze more
    than once takes this list once and reads all of it as of then."""
    return [n.removeprefix("batch=") for n, _ in paths.children(spark, manifests_path(root)) if n.startswith("batch=")]


def read_manifests(
    spark: SparkSession, root: str, years: list[str] | None = None, batches: list[str] | None = None
) -> DataFrame:
    """(year, buoy_id, source_stem, lines_flagged, batch) of every committed
    source version: one small row per source and batch."""
    path = manifests_path(root)
    if batches is not None and not batches:
        return spark.createDataFrame([], _MANIFEST)
    df = spark.read.schema(_MANIFEST).option("basePath", path).parquet(*([path] if batches is None else [f"{path}/batch={b}" for b in batches]))
    return df if years is None else df.where(F.col("year").isin([str(y) for y in years]))


def newest_versions(manifests: DataFrame) -> DataFrame:
    """(year, buoy_id, source_stem, batch, lines_flagged): the version of each source that counts."""
    newest = manifests.groupBy(*SOURCE_KEY).agg(F.max(F.struct("batch", "lines_flagged")).alias("_newest"))
    return newest.select(*SOURCE_KEY, "_newest.*")


def superseded_versions(manifests: DataFrame) -> DataFrame:
    """(year, buoy_id, source_stem, batch) of every source version that a
    later batch replaced, from the manifests alone."""
    newest = manifests.groupBy(*SOURCE_KEY).agg(F.max("batch").alias("_newest"))
    return manifests.join(newest, SOURCE_KEY).where(F.col("batch") < F.col("_newest")).select(*SOURCE_KEY, "batch")


def version_folders(manifests: DataFrame) -> DataFrame:
    """(batch, year, sources, current, replaced_by) of every bronze folder: how many source
    versions it holds, how many of them still count, and the batch that replaced its
    last one (NULL while one counts)."""
    later = Window.partitionBy(*SOURCE_KEY).orderBy("batch")
    versions = manifests.select(*SOURCE_KEY, "batch", F.lead("batch").over(later).alias("_next"))
    return versions.groupBy("batch", "year").agg(
        F.count(F.lit(1)).alias("sources"),
        F.count_if(F.col("_next").isNull()).alias("current"),
        F.when(F.count_if(F.col("_next").isNull()) == 0, F.max("_next")).alias("replaced_by"),
    )


#: Characters that Spark escapes in the name of a partition folder.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(k) for k in range(1, 32)}


def folder_path(root: str, batch: str, year: str | None) -> str:
    """Where a batch's rows of a year lie."""
    name = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in year) if year else "__HIVE_DEFAULT_PARTITION__"
    return f"{observations_path(root)}/batch={batch}/year={name}"


def read_bronze_observations(
    spark: SparkSession,
    root: str,
    year: str | None = None,
    years: list[str] | None = None,
    batches: list[str] | None = None,
) -> DataFrame:
    """Current bronze rows: each source's newest committed batch only.

    The manifests choose the folders: one whose sources were all replaced is not
    opened, one that holds only current versions is scanned plainly, and only the rows
    of mixed folders pass an anti-join with the (counted) replaced versions. A
    row per folder reaches the driver. ``batches``: as of an earlier
    ``committed_batches``.
    """
    wanted = [str(year)] if year is not None else years
    held = committed_batches(spark, root) if batches is None else batches
    manifests = read_manifests(spark, root, wanted, held)
    folders = version_folders(manifests).where("current > 0").orderBy("year", "batch").collect() if held else []
    if not folders:
        return spark.createDataFrame([], BRONZE_OBSERVATIONS)

    def scan(chosen: list) -> DataFrame:
        found = [folder_path(root, r["batch"], r["year"]) for r in chosen]
        return spark.read.schema(BRONZE_OBSERVATIONS).option("basePath", observations_path(root)).parquet(*found)

    whole = [r for r in folders if r["current"] == r["sources"]]
    mixed = [r for r in folders if r["current"] < r["sources"]]
    if not mixed:
        return scan(whole)
    names = spark.createDataFrame([(r["batch"], r["year"]) for r in mixed], "batch string, year string")
    old = superseded_versions(manifests).join(F.broadcast(names), ["batch", "year"], "left_semi")
    few = sum(r["sources"] - r["current"] for r in mixed) <= BROADCAST_VERSIONS
    rest = scan(mixed).join(F.broadcast(old) if few else old, [*SOURCE_KEY, "batch"], "left_anti").select(*BRONZE_OBSERVATIONS.fieldNames())
    return scan(whole).unionByName(rest) if whole else rest


def current_sources(spark: SparkSession, root: str) -> DataFrame:
    """``(buoy_id, year, source_stem, batch, usable)`` of every source file
    held in bronze. A batch is committed after its files, so they are readable."""
    if not paths.exists(spark, manifests_path(root)):
        return spark.createDataFrame([], "year string, buoy_id string, source_stem string, batch string, usable boolean")
    return read_manifests(spark, root).groupBy(*SOURCE_KEY).agg(F.max("batch").alias("batch")).withColumn("usable", F.lit(True))


def flagged_lines(spark: SparkSession, root: str, years: list[str], batches: list[str] | None = None) -> dict[str, int]:
    """Lines per year that the decoder flagged in the current source versions."""
    newest = newest_versions(read_manifests(spark, root, years, batches))
    return {r["year"]: int(r["n"]) for r in newest.groupBy("year").agg(F.sum("lines_flagged").alias("n")).collect()}


def vacuum_bronze(spark: SparkSession, root: str, grace_hours: float = 24.0, now: dt.datetime | None = None) -> list[str]:
    """Delete what no reader chooses any more: folders whose sources were all replaced, the last
    of them by a batch committed over ``grace_hours`` ago, and batches that old which were
    never committed. Manifests stay. Returns the removed paths (one per folder)."""
    cutoff = ((now or dt.datetime.now(dt.timezone.utc)) - dt.timedelta(hours=grace_hours)).timestamp() * 1000
    committed = {n.removeprefix("batch="): changed for n, changed in paths.children(spark, manifests_path(root)) if n.startswith("batch=")}
    gone = version_folders(read_manifests(spark, root, batches=sorted(committed))).where("current = 0").collect() if committed else []
    removed = [folder_path(root, r["batch"], r["year"]) for r in gone if committed[r["replaced_by"]] < cutoff]
    for name, changed in paths.children(spark, observations_path(root)):
        if name.startswith("batch=") and name.removeprefix("batch=") not in committed and changed < cutoff:
            removed.append(f"{observations_path(root)}/{name}")
    removed = sorted(p for p in removed if paths.exists(spark, p))
    for path in removed:
        paths.delete(spark, path)
    return removed


def read_bronze_coordinates(spark: SparkSession, root: str) -> DataFrame:
    """Raw coordinate rows plus the file they came from (for a
    deterministic first value)."""
    return (
        spark.read.schema(BRONZE_COORDINATES)
        .parquet(coordinates_path(root))
        .withColumn("path", F.col("_metadata.file_path"))
    )


def latest_coordinate_rows(raw: DataFrame) -> DataFrame:
    """Rows of each station's latest ingest batch (a re-scrape replaces the
    earlier position). The dimension is small: one window over it."""
    latest = F.max("batch").over(Window.partitionBy("buoy_id"))
    return raw.withColumn("_latest", latest).where(F.col("batch") == F.col("_latest")).drop("_latest")


def read_observations(spark: SparkSession, root: str, year: str | None = None) -> DataFrame:
    """Library entry point: bronze -> clean silver rows (contract schema).
    A year-scoped read dedups within that year; a whole-tree read globally."""
    return obs.clean_observations(read_bronze_observations(spark, root, year))


def read_coordinates(spark: SparkSession, root: str) -> DataFrame:
    """One row per buoy: its latest batch, first non-NULL value per column."""
    return collapse_coordinates(latest_coordinate_rows(read_bronze_coordinates(spark, root)), "path")


def bronze_inventory(spark: SparkSession, root: str, dataset: str = "observations") -> DataFrame:
    """``(path, length, modificationTime, <hive keys>)`` per bronze file.

    The ``binaryFile`` source lists files with their metadata; ``content``
    is not selected, so no file body is read. Zero-byte files are not
    listed at all, so they count as absent (and are fetched again).
    """
    path = f"{root.rstrip('/')}/{dataset}"
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("basePath", path)
        .load(path)
    )
    keys = [c for c in ("buoy_id", "year", "source_stem", "batch") if c in df.columns]
    return df.select("path", "length", "modificationTime", *[F.col(k).cast("string").alias(k) for k in keys])


_PROBE_SCHEMA = "path string, usable boolean, num_columns int, schema_signature string"


@contextmanager
def open_parquet(path: str):
    """A Parquet file of any file system that Arrow knows, opened in a task."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    uri = "file://" + path[len("file:"):] if path.startswith("file:/") and not path.startswith("file://") else path
    fs, inner = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(inner) as handle:
        yield pq.ParquetFile(handle)


def _probe_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow as pa

    for batch in batches:
        out = []
        for p in batch["path"]:
            try:
                with open_parquet(p) as file:
                    schema = file.schema_arrow
                    out.append((p, len(schema) > 0, len(schema), ",".join(f"{f.name}:{f.type}" for f in schema)))
            except (FileNotFoundError, pa.ArrowInvalid):
                # absent, cut off, not Parquet: "fetch again"; any other error
                # (storage, permission) says nothing about the file and raises
                out.append((p, False, 0, None))
        yield pd.DataFrame(out, columns=["path", "usable", "num_columns", "schema_signature"])


def probe_usable(inventory: DataFrame) -> DataFrame:
    """Per file: readable footer with at least one column -> usable. A
    header-only file (zero rows) is usable. Footers are read in the tasks,
    in Arrow batches; the inventory is partitioned like any other table."""
    kept = [f for f in inventory.schema.fields if f.name != "path"]
    probed = inventory.select("path").mapInPandas(_probe_footers, _PROBE_SCHEMA)
    return inventory.join(probed, "path", "left") if kept else probed
