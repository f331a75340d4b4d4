"""Bronze writers: decoded observation files and station coordinates.

Both are append-only, one folder per ingest job (a batch), so two jobs never
write into one folder. Observations land under ``batch=<id>/year=<y>/`` and a
small manifest of the batch's sources is written last: it commits the batch,
and tells readers which source versions are current without opening the data.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.stations import page_counters
from tidewater.schema import BRONZE_OBSERVATIONS, BRONZE_VALUE_COLUMNS
from tidewater.sources import paths
from tidewater.sources.bronze import SOURCE_KEY, coordinates_path, manifests_path, observations_path
from tidewater.sources.station_text import decode_station_text


class Counted:
    """Counters observed while a frame is written.

    A plan that adaptive execution finds empty reports no metrics; the same
    counters are then computed over the frame itself, never assumed.
    """

    def __init__(self, frame: DataFrame, **metrics: Column):
        self.observation, self.source = Observation(), frame
        self.metrics = [m.alias(k) for k, m in metrics.items()]
        self.names = list(metrics)
        self.frame = frame.observe(self.observation, *self.metrics)

    def get(self) -> dict[str, int]:
        try:
            found = dict(self.observation.get)
        except Exception:  # noqa: BLE001 -- no metrics: counted below, where errors raise
            found = {}
        if any(found.get(n) is None for n in self.names):
            found = self.source.agg(*self.metrics).first().asDict()
        return {n: int(found[n]) for n in self.names}


def write_bronze_observations(text: DataFrame, root: str) -> dict:
    """Decode landed files ``(buoy_id, year, source_stem, value)`` and write
    them to bronze. Returns counters gathered in the same job: files
    skipped for having no header at all (nothing is written for them, so
    they are fetched again), lines flagged by the decoder, rows written.

    The header line is kept as row 0, so a header-only file still lands as
    a readable one-row source and counts as already fetched.
    """
    # Files are counted where they are read (a map stage: a retried stage
    # may count again; these are run statistics, the data stays exact).
    marked = text.withColumn("_empty", F.coalesce(F.col("value"), F.lit("")).rlike(r"^\s*$"))
    files = Counted(marked, files_seen=F.count(F.lit(1)), bronze_skipped_no_schema=F.count_if(F.col("_empty")))
    decoded = decode_station_text(files.frame.where(~F.col("_empty")).drop("_empty"), keep_header=True)
    counters = write_bronze_frame(decoded, root)
    return {**files.get(), **counters}


def write_bronze_frame(decoded: DataFrame, root: str, batch: str | None = None) -> dict:
    """Write bronze-shaped rows (absent columns are NULL) as one ingest batch and commit it.

    Rows are rebalanced by year: adaptive execution puts small years together and cuts
    large ones at the advisory partition size, so the number of files follows the
    bytes, not tasks times years. Files are sorted by (station, source, line), so the
    repeated key columns compress to runs. A source written again in a later batch
    supersedes its earlier version at read time (``read_bronze_observations``).
    """
    spark = decoded.sparkSession
    batch = batch or ingest_batch_id(spark, manifests_path(root))
    blank = {f.name: F.lit(None).cast(f.dataType) for f in BRONZE_OBSERVATIONS.fields if f.name not in {*decoded.columns, "batch"}}
    shaped = decoded.withColumns(blank).select("buoy_id", "source_stem", "line_no", *BRONZE_VALUE_COLUMNS, "extra", "decode_error", "year")
    counted = Counted(shaped, rows_written=F.count(F.lit(1)), lines_flagged=F.count_if(F.col("decode_error").isNotNull()))
    out = f"{observations_path(root)}/batch={batch}"
    ordered = counted.frame.hint("rebalance", F.col("year")).sortWithinPartitions("year", "buoy_id", "source_stem", "line_no")
    ordered.write.mode("errorifexists").partitionBy("year").parquet(out)
    counters = counted.get()
    if counters["rows_written"]:
        held = spark.read.schema("buoy_id string, source_stem string, decode_error string, year string").parquet(out)
        manifest = held.groupBy(*SOURCE_KEY).agg(F.count_if(F.col("decode_error").isNotNull()).alias("lines_flagged"))
        manifest.write.mode("errorifexists").parquet(f"{manifests_path(root)}/batch={batch}")
    else:
        paths.delete(spark, out)
    return counters


def ingest_batch_id(spark: SparkSession, folder: str) -> str:
    """Sortable id of one ingest run (UTC, microseconds), later than every
    batch that ``folder`` holds whatever this host's clock says."""
    now = int(dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f"))
    known = [int(n.removeprefix("batch=").split("-")[0]) for n, _ in paths.children(spark, folder) if n.startswith("batch=")]
    return f"{max([now, *(k + 1 for k in known)]):020d}-{uuid.uuid4().hex[:6]}"


def write_bronze_coordinates(positions: DataFrame, root: str, batch: str | None = None) -> dict:
    """One row per scraped station page, in a folder of the ingest batch.
    Readers take each station's latest batch, so a re-scraped page replaces
    the old position. Returns missing / unparseable counters (same job)."""
    spark = positions.sparkSession
    shaped = positions.select(
        F.col("buoy_id").cast("string").alias("buoy_id"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("status").cast("string").alias("status"),
    )
    counted = Counted(shaped, **page_counters())
    counted.frame.write.mode("errorifexists").parquet(f"{coordinates_path(root)}/batch={batch or ingest_batch_id(spark, coordinates_path(root))}")
    return counted.get()
