"""What sorted files tell without a shuffle: key ranges, order and repeated keys.

A published year is files that are ranges of (buoy, instant), sorted within. Equal
keys are therefore neighbours, in a file or across the end of one file and the start of the
next, and uniqueness needs no grouping: each task compares the neighbours of what it
scans, and only the first and last key of each stretch go on (a row per file and
scan partition).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_STRETCH = (
    "file string, at bigint, rows bigint, first_buoy string, last_buoy string, first_datetime timestamp_ntz, last_datetime timestamp_ntz, "
    "min_datetime timestamp_ntz, max_datetime timestamp_ntz, repeated bigint, descending bigint"
)


def stretches(snapshot: DataFrame) -> DataFrame:
    """One row per contiguous stretch of a file that a task has read, as ``_STRETCH``; rows
    are ``(buoy_id, datetime)`` straight from a file scan."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            file, index, buoy, when = (batch.column(c) for c in ("file", "row_index", "buoy_id", "datetime"))
            place = np.asarray(index)
            near = {"file": pc.equal(file.slice(1), file.slice(0, n - 1)).to_numpy(zero_copy_only=False)}
            joined = near["file"] & (place[1:] == place[:-1] + 1)
            same_buoy = pc.equal(buoy.slice(1), buoy.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            less = pc.less(buoy.slice(1), buoy.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            moment = np.asarray(when.cast(pa.int64()))
            repeated = joined & same_buoy & (moment[1:] == moment[:-1])
            descending = joined & (less | (same_buoy & (moment[1:] < moment[:-1])))
            starts = np.concatenate([[0], np.flatnonzero(~joined) + 1])
            ends = np.append(starts[1:], n)
            many, down = (np.concatenate([[0], np.cumsum(x)]) for x in (repeated, descending))
            at, last = pa.array(starts), pa.array(ends - 1)
            low, high = np.minimum.reduceat(moment, starts), np.maximum.reduceat(moment, starts)
            columns = [
                file.take(at), index.take(at), pa.array(ends - starts), buoy.take(at), buoy.take(last), when.take(at), when.take(last),
                pa.array(low).cast(when.type), pa.array(high).cast(when.type), pa.array(many[ends - 1] - many[starts]), pa.array(down[ends - 1] - down[starts]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _STRETCH.split(", ")])

    scan = snapshot.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index"), "buoy_id", "datetime")
    return scan.mapInArrow(walk, _STRETCH)


def file_index(found: DataFrame) -> DataFrame:
    """One row per file: its rows and the ranges of its stations and instants."""
    return found.groupBy("file").agg(
        F.sum("rows").alias("rows"), F.min("first_buoy").alias("first_buoy"), F.max("last_buoy").alias("last_buoy"),
        F.min("min_datetime").alias("first_datetime"), F.max("max_datetime").alias("last_datetime"),
    )


def neighbour_check(found: DataFrame) -> DataFrame:
    """``(check, violations)``: keys that repeat among neighbours, and neighbours out of order
    (which would leave the first figure unproven). Files of one folder follow each other by first key."""
    folder = F.regexp_replace("file", "/[^/]*$", "")
    order = Window.partitionBy("folder").orderBy("first_buoy", "first_datetime", "file", "at")
    before = found.withColumn("folder", folder).select("*", F.lag("last_buoy").over(order).alias("_buoy"), F.lag("last_datetime").over(order).alias("_when"))
    equal = (F.col("_buoy") == F.col("first_buoy")) & (F.col("_when") == F.col("first_datetime"))
    over = (F.col("_buoy") > F.col("first_buoy")) | ((F.col("_buoy") == F.col("first_buoy")) & (F.col("_when") > F.col("first_datetime")))
    sums = before.agg(
        F.coalesce(F.sum("repeated") + F.count_if(equal), F.lit(0)).alias("repeated"),
        F.coalesce(F.sum("descending") + F.count_if(over), F.lit(0)).alias("unordered"),
    )
    return sums.select(F.explode(F.array(
        F.struct(F.lit("unique_key").alias("check"), F.col("repeated").alias("violations")),
        F.struct(F.lit("sorted_files").alias("check"), F.col("unordered").alias("violations")),
    )).alias("row")).select("row.*")
