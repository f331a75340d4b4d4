"""Year-partition admission: which typed rows may enter their year snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def year_bounds(year: Column | str) -> tuple[Column, Column]:
    """Half-open ``[Jan 1 y, Jan 1 y+1)`` as zone-less timestamps."""
    y = (F.col(year) if isinstance(year, str) else year).try_cast("int")
    low = F.make_date(y, F.lit(1), F.lit(1)).cast("timestamp_ntz")
    high = F.make_date(y + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz")
    return low, high


def admissible(load_year: Column | str = "load_year") -> Column:
    """Buoy and instant present, instant inside the row's own load year."""
    low, high = year_bounds(load_year)
    dt = F.col("datetime")
    return (
        F.col("buoy_id").isNotNull()
        & dt.isNotNull()
        & (dt >= low)
        & (dt < high)
    )


def admission_counts(deduped: DataFrame, load_year: str = "load_year") -> DataFrame:
    """Per load year: total, admitted and rejected rows, counted after dedup.

    One pass with conditional counts; the aggregate is partial map-side, so
    a year holding most rows costs one small partial row per task.
    """
    ok = admissible(load_year)
    return (
        deduped.groupBy(F.col(load_year).alias("load_year"))
        .agg(F.count(F.lit(1)).alias("rows_total"), F.count_if(ok).alias("rows_loaded"))
        .withColumn("rows_rejected", F.col("rows_total") - F.col("rows_loaded"))
    )


def dimension_count(stations: DataFrame) -> DataFrame:
    """One row: stations of the dimension (one row each)."""
    return stations.agg(F.count(F.lit(1)).alias("stations"))
