"""Ingest: landed text and pages -> bronze; archive index -> fetch plan.

Fetching itself (HTTP) is outside Spark; whatever tool fetches writes the
responses somewhere Spark can read them, and these jobs take over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import coordinates as coords
from tidewater.functions import links
from tidewater.operators import incremental
from tidewater.operators.stations import distinct_by_url
from tidewater.session import configure
from tidewater.sinks import bronze as bronze_sink
from tidewater.sources import bronze
from tidewater.sources.station_text import landed_station_files


def landed_text_frame(responses: DataFrame) -> DataFrame:
    """``(url, buoy_id, value)`` responses -> ``(buoy_id, year, source_stem,
    value)``, each URL once.

    Of several responses for one URL the one of smallest text hash is kept, so
    a rerun keeps the same. Only the hashes are compared across tasks: texts
    move only for the URLs that really occur more than once.
    """
    keyed = responses.select("url", "buoy_id", "value", F.xxhash64("buoy_id", "value").alias("_key"))
    per_url = keyed.groupBy("url").agg(F.min("_key").alias("_keep"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = per_url.select("url", "_keep")
    single = keyed.join(repeated, "url", "left_anti")
    several = keyed.join(repeated, "url").where(F.col("_key") == F.col("_keep")).dropDuplicates(["url"])
    once = single.select("url", "buoy_id", "value").unionByName(several.select("url", "buoy_id", "value"))
    return links.with_source_identity(once, "url").select("buoy_id", "year", "source_stem", "value")


def ingest_station_text(spark: SparkSession, responses: DataFrame, bronze_root: str) -> dict:
    """Responses ``(buoy_id, url, value)`` -> one bronze batch."""
    configure(spark)
    return bronze_sink.write_bronze_observations(landed_text_frame(responses), bronze_root)


def ingest_landed_files(spark: SparkSession, landed_root: str, bronze_root: str) -> dict:
    """Landed files ``<landed_root>/buoy_id=<id>/<stem>.txt[.gz]`` -> one bronze batch."""
    configure(spark)
    return bronze_sink.write_bronze_observations(landed_station_files(spark, landed_root), bronze_root)


def ingest_station_pages(spark: SparkSession, pages: DataFrame, bronze_root: str) -> dict:
    """Station pages ``(buoy_id, html)`` -> bronze coordinates."""
    configure(spark)
    return bronze_sink.write_bronze_coordinates(coords.positions_from_pages(pages), bronze_root)


def archive_links(index_pages: DataFrame) -> DataFrame:
    """Archive index pages ``(url, html)`` -> one row per (station, year
    link). An index with no station entries means the page layout moved:
    that is an error, not an empty crawl (checked with one tiny job)."""
    out = links.explode_archive_index(index_pages)
    found = out.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("buoy_id").isNull()).alias("unnamed")).first()
    if not found["n"]:
        raise ValueError("the archive index lists no station: has its layout changed?")
    if found["unnamed"]:
        raise ValueError(f"{found['unnamed']} links of the archive index stand under no station id")
    return out


def plan_fetch(
    spark: SparkSession, index_pages: DataFrame, bronze_root: str, as_of_year: int, full_refresh: bool = False
) -> DataFrame:
    """(kind, buoy_id, year, source_stem, url) to fetch: every archive link minus
    closed years already in bronze as readable files, and the page of each
    station. Unknown years and the current year are always fetched;
    ``full_refresh`` fetches everything."""
    configure(spark)
    listed = archive_links(index_pages)
    wanted = listed.select("buoy_id", "year", "source_stem", F.col("link").alias("url"))
    cache = bronze.current_sources(spark, bronze_root)
    files = incremental.fetch_plan(wanted, cache, as_of_year, full_refresh).select(F.lit("observations").alias("kind"), "*")
    pages = distinct_by_url(listed.select("buoy_id", F.col("station_url").alias("url")), "url", ["buoy_id"])
    return files.unionByName(pages.select(F.lit("station_page").alias("kind"), "buoy_id", "url"), allowMissingColumns=True)
