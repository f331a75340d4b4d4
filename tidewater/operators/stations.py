"""Station dimension: collapse per buoy, attach positions to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.schema import COORDINATE_COLUMNS


def collapse_coordinates(raw: DataFrame, order_col: str = "path") -> DataFrame:
    """One row per buoy: first non-NULL latitude and, independently, first
    non-NULL longitude, by ``order_col`` (deterministic where the reference
    takes any value). ``min_by`` skips rows whose ordering is NULL, so the
    ``when`` acts as the ignore-NULL filter; the aggregate is partial map-side.
    """
    lat, lon, order = F.col("latitude"), F.col("longitude"), F.col(order_col)
    return raw.groupBy("buoy_id").agg(
        F.min_by(lat.cast("double"), F.when(lat.isNotNull(), order)).alias("latitude"),
        F.min_by(lon.cast("double"), F.when(lon.isNotNull(), order)).alias("longitude"),
    ).select(*COORDINATE_COLUMNS)


def with_position(observations: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Left join of the dimension by ``buoy_id`` at query time.

    No broadcast hint: the dimension is one row per station, and the planner
    (statically from file sizes, and again under AQE from the measured
    shuffle size) broadcasts it only while it is under
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that the same plan runs
    as a sort-merge join.
    """
    return observations.join(coordinates.select(*COORDINATE_COLUMNS), "buoy_id", "left")


def distinct_by_url(df: DataFrame, url_col: str = "url", order_cols: list[str] | None = None) -> DataFrame:
    """Each URL once. With ``order_cols`` the kept row is the first by them
    (deterministic); without, any row is kept (``dropDuplicates``). Both are
    partial aggregates, so a URL repeated across many tasks is cut map-side."""
    if not order_cols:
        return df.dropDuplicates([url_col])
    others = [c for c in df.columns if c != url_col]
    first = F.min_by(F.struct(*others), F.struct(*order_cols)).alias("_first")
    return df.groupBy(url_col).agg(first).select(url_col, "_first.*")


def page_counters() -> dict[str, Column]:
    """Counters of scraped station pages, by the status of their position."""
    return {
        "stations": F.count(F.lit(1)),
        "coordinates_missing": F.count_if(F.col("status") == "missing"),
        "coordinates_unparseable": F.count_if(F.col("status") == "unparseable"),
    }
