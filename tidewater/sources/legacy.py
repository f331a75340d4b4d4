"""Convert an existing per-file bronze tree into this engine's bronze layout.

Source layout: ``observations/buoy_id=<id>/year=<y>/<stem>.parquet``, one
file per landed source, each with its own header as column names and its
own inferred column types (integers in one file, text in the next), and
with month ``MM`` and minute ``mm`` side by side. Such files cannot be read
in one scan: schema merge fails on the type drift, and ``MM``/``mm`` collide
under case-insensitive resolution.

So each task opens the files of its part of the inventory, turns every column
into text and yields bronze rows: one job whatever the number of files or
schemas, and no file list passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.schema import BRONZE_OBSERVATIONS, MEASUREMENT_NAMES, STRUCTURAL_COLUMNS
from tidewater.session import configure
from tidewater.sinks.bronze import write_bronze_coordinates, write_bronze_frame
from tidewater.sources.bronze import bronze_inventory, open_parquet, probe_usable

#: Header name -> bronze column.
_COLUMNS = {**STRUCTURAL_COLUMNS, **{m: m for m in MEASUREMENT_NAMES}}
_PATH = re.compile(r"buoy_id=([^/]+)/year=([^/]+)/([^/]+)\.parquet$")
_ROWS_SCHEMA = "buoy_id string, source_stem string, line_no int, " + ", ".join(f"`{c}` string" for c in _COLUMNS.values()) + ", year string"


def _as_text(values: pa.Array, whole: bool) -> pa.Array:
    """Text of a column. A date or time field that the file typed as a float
    (one short line is enough) holds whole numbers: ``30.0`` is minute 30."""
    if pa.types.is_floating(values.type):
        values = pc.if_else(pc.is_nan(values), pa.scalar(None, values.type), values)
        text = values.cast(pa.string())
        if whole:
            integral = pc.equal(values, pc.floor(values))
            return pc.if_else(integral, pc.if_else(integral, values, 0).cast(pa.int64()).cast(pa.string()), text)
        return text
    return values.cast(pa.string())


def _file_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bronze rows of every listed file: its header as row 0, then its rows."""
    names = ["buoy_id", "source_stem", "line_no", *_COLUMNS.values(), "year"]
    for batch in batches:
        for path in batch.column("path").to_pylist():
            buoy, year, stem = _PATH.search(path).groups()
            with open_parquet(path) as file:  # row group by row group: no file is held whole
                present = set(file.schema_arrow.names)
                header = [pa.array([h if h in present else None], pa.string()) for h in _COLUMNS]
                at = 0
                for n, texts in chain([(1, header)], _texts(file, present)):
                    fixed = [pa.array([v] * n, pa.string()) for v in (buoy, stem, year)]
                    lines = pa.array(range(at, at + n), pa.int32())
                    at += n
                    yield pa.RecordBatch.from_arrays([fixed[0], fixed[1], lines, *texts, fixed[2]], names)


def _texts(file, present: set[str]) -> Iterator[tuple[int, list[pa.Array]]]:
    """(rows, bronze columns) of each batch of an open file."""
    for rows in file.iter_batches():
        yield rows.num_rows, [_as_text(rows.column(h), h in STRUCTURAL_COLUMNS) if h in present else pa.nulls(rows.num_rows, pa.string()) for h in _COLUMNS]


def convert_legacy_bronze(spark: SparkSession, legacy_root: str, bronze_root: str) -> dict:
    """Rewrite a legacy bronze tree as text-typed bronze. Returns counters:
    files converted and unusable ones (no columns, cut off), which are left out."""
    configure(spark)
    probed = probe_usable(bronze_inventory(spark, legacy_root))
    counts = {r["usable"]: r["n"] for r in probed.groupBy("usable").agg(F.count("*").alias("n")).collect()}
    files = {"files": counts.get(True, 0), "unusable": counts.get(False, 0)}
    if not files["files"]:
        return {**files, "rows_written": 0, "lines_flagged": 0}
    rows = probed.where("usable").select("path").mapInArrow(_file_rows, _ROWS_SCHEMA)
    empty = {f.name: F.lit(None).cast(f.dataType) for f in BRONZE_OBSERVATIONS.fields if f.name in ("extra", "decode_error")}
    return {**files, **write_bronze_frame(rows.withColumns(empty), bronze_root)}


def convert_legacy_coordinates(spark: SparkSession, legacy_root: str, bronze_root: str) -> dict:
    """Legacy ``coordinates/buoy_id=<id>/part.parquet`` (hive key read as
    text, values cast strictly to double) -> one appended coordinate batch."""
    configure(spark)
    base = f"{legacy_root.rstrip('/')}/coordinates"
    # Explicit schema: a page without a position was written with all-NULL
    # columns (no float type in the file), so the files' own types disagree.
    raw = spark.read.schema("latitude double, longitude double, buoy_id string").option("basePath", base).parquet(base)
    found = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    positions = raw.select("buoy_id", "latitude", "longitude", F.when(found, F.lit("ok")).otherwise(F.lit("missing")).alias("status"))
    return write_bronze_coordinates(positions, bronze_root)
