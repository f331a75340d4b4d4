"""Incremental loading: year discovery, fingerprints, change detection and
the fetch plan, all as joins and aggregates over inventory tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FOUR_DIGITS = r"^[0-9]{4}$"


def epoch_text(ts: Column) -> Column:
    """Seconds since the epoch with six decimals, built from integer
    microseconds so no floating-point rounding is involved."""
    us = F.unix_micros(ts.cast("timestamp"))
    return F.concat(
        F.floor(us / 1_000_000).cast("long").cast("string"),
        F.lit("."),
        F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0"),
    )


def year_fingerprints(inventory: DataFrame, years: DataFrame | None = None) -> DataFrame:
    """``count:newest-mtime`` per year over a file inventory
    ``(year, modificationTime, ...)``; ``empty`` for requested years without
    files. A deliberately cheap change detector: metadata only, never content.
    For trees whose files become visible whole; our own bronze commits batches,
    so its loads compare ``committed_fingerprints``.
    """
    fp = inventory.groupBy("year").agg(
        F.count(F.lit(1)).alias("file_count"), F.max("modificationTime").alias("newest")
    ).select(
        "year",
        "file_count",
        F.concat(F.col("file_count").cast("string"), F.lit(":"), epoch_text(F.col("newest"))).alias(
            "bronze_fingerprint"
        ),
    )
    if years is None:
        return fp
    return years.select("year").join(fp, "year", "left").select(
        "year",
        F.coalesce("bronze_fingerprint", F.lit("empty")).alias("bronze_fingerprint"),
        F.coalesce("file_count", F.lit(0).cast("long")).alias("file_count"),
    )


def committed_fingerprints(versions: DataFrame) -> DataFrame:
    """(year, sources, bronze_fingerprint) over committed source versions ``(year, buoy_id,
    source_stem, batch)``: how many sources a year holds, and a sum of hashes of each
    source with its newest batch, so the order of rows doesn't count.

    Only commits change it. Files of a batch that is still being written, or that
    were cleaned away after their replacement, don't.
    """
    newest = versions.groupBy("year", "buoy_id", "source_stem").agg(F.max("batch").alias("batch"))
    name = F.concat_ws("/", F.coalesce("buoy_id", F.lit("")), F.coalesce("source_stem", F.lit("")), "batch")
    mark = F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("decimal(38,0)")
    return newest.groupBy("year").agg(F.count(F.lit(1)).alias("sources"), F.sum(mark).alias("marks")).select(
        "year", "sources", F.concat(F.col("sources").cast("string"), F.lit(":"), F.col("marks").cast("string")).alias("bronze_fingerprint")
    )


def is_loadable_year(year: Column | str = "year") -> Column:
    c = F.col(year) if isinstance(year, str) else year
    return c.rlike(_FOUR_DIGITS)


def discover_years(inventory: DataFrame) -> DataFrame:
    """Distinct hive years with a ``usable`` flag (four digits). Unusable
    years (``unknown``) are reported, never loaded."""
    return inventory.select("year").distinct().withColumn("usable", is_loadable_year("year"))


def changed_years(current: DataFrame, ledger_latest: DataFrame, force: bool = False) -> DataFrame:
    """Loadable years whose fingerprint is new or differs from the ledger's
    latest row for that year (one row per year on both sides, so a single
    left join decides both). ``force`` ignores the ledger."""
    candidates = current.where(is_loadable_year("year"))
    if force:
        return candidates.withColumn("reason", F.lit("forced"))
    led = ledger_latest.select(
        F.col("year").cast("string").alias("year"), F.col("bronze_fingerprint").alias("_loaded_fp")
    )
    loaded = F.col("_loaded_fp")
    return (
        candidates.join(led, "year", "left")
        .where(loaded.isNull() | (loaded != F.col("bronze_fingerprint")))
        .withColumn("reason", F.when(loaded.isNull(), F.lit("new")).otherwise(F.lit("changed")))
        .drop("_loaded_fp")
    )


def reusable_cache(cache: DataFrame, as_of_year: int, full_refresh: bool = False) -> DataFrame:
    """Bronze files that never need fetching again: not a full refresh, a
    numeric year before the current (UTC) year, and a readable file."""
    if full_refresh:
        return cache.limit(0)
    y = F.col("year")
    return cache.where(
        is_loadable_year(y) & (y.try_cast("int") < F.lit(as_of_year)) & F.col("usable")
    )


def unique_links(links: DataFrame) -> DataFrame:
    """Each URL once; when one URL is listed under several stations the
    smallest row wins, so the plan does not depend on task order. A partial
    aggregate: repeats of a URL collapse map-side."""
    others = [c for c in links.columns if c != "url"]
    if not others:
        return links.distinct()
    return links.groupBy("url").agg(F.min(F.struct(*others)).alias("_row")).select("url", "_row.*").select(*links.columns)


def fetch_counts(links: DataFrame, cache: DataFrame, as_of_year: int, full_refresh: bool = False) -> DataFrame:
    """One row: distinct links, links skipped because their closed year is
    already in bronze, and links to fetch (the crawl's skip counter)."""
    keep = (
        reusable_cache(cache, as_of_year, full_refresh)
        .select("buoy_id", "year", "source_stem")
        .distinct()
        .withColumn("_cached", F.lit(True))
    )
    flagged = unique_links(links).join(keep, ["buoy_id", "year", "source_stem"], "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("links"),
        F.count_if(F.col("_cached")).alias("skipped_cached"),
        F.count_if(F.col("_cached").isNull()).alias("to_fetch"),
    )


def fetch_plan(links: DataFrame, cache: DataFrame, as_of_year: int, full_refresh: bool = False) -> DataFrame:
    """Links still to fetch: each URL once, minus closed, readable years
    already in bronze (matched on buoy, year and source stem)."""
    keep = reusable_cache(cache, as_of_year, full_refresh).select("buoy_id", "year", "source_stem")
    return unique_links(links).join(keep, ["buoy_id", "year", "source_stem"], "left_anti")
