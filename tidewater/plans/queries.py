"""Registered queries: each runs a library operator over the driver's tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names match the DuckDB oracle in ``tidewater.plans.oracles``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import coordinates as coords
from tidewater.functions import links
from tidewater.operators import admission, checks, incremental, monitoring, stations
from tidewater.operators import observations as obs
from tidewater.plans import derived
from tidewater.plans.silver_load import run_silver
from tidewater.plans.tables import table
from tidewater.schema import BRONZE_VALUE_COLUMNS
from tidewater.session import configure
from tidewater.sinks import silver
from tidewater.sinks.bronze import write_bronze_frame
from tidewater.sources import bronze, paths
from tidewater.sources.station_text import decode_station_text

Query = Callable[[SparkSession, str], DataFrame]


def _bronze_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    text = derived.station_text_from_events(table(spark, sf_dir, "events"))
    return decode_station_text(text)


def station_text_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 + PRJ10: landed text -> bronze rows, every token kept as text."""
    bronze = _bronze_from_events(spark, sf_dir)
    return bronze.select("buoy_id", "year", "source_stem", "line_no", *BRONZE_VALUE_COLUMNS)


def sentinel_nullify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT1, PRJ1-PRJ8: units rows dropped, fields typed, sentinels -> NULL."""
    typed = obs.normalize(_bronze_from_events(spark, sf_dir))
    return typed.select("load_year", "source_stem", "line_no", *obs.OBSERVATION_COLUMNS)


def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN1 + PRJ9: the full silver transform, one row per (buoy, instant)."""
    return obs.clean_observations(_bronze_from_events(spark, sf_dir))


# Fixed "now" of the registered queries: the events span January 2024 and
# the orders 1995-2001, so the clock is a parameter, never the wall clock.
EVENTS_AS_OF = "2024-02-01 00:00:00"
ORDERS_AS_OF_YEAR = 2000
LEDGER_CUTOFF = "1999-07-01"


def year_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ5, PRJ6: two-digit years pivot at 50; impossible dates -> NULL."""
    texts = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "lpad(CAST(year(l_shipdate) % 100 AS STRING), 2, '0') AS y2",
        "lpad(CAST(month(l_shipdate) AS STRING), 2, '0') AS m",
        "CASE WHEN l_linenumber = 7 THEN '31' ELSE lpad(CAST(day(l_shipdate) AS STRING), 2, '0') END AS d",
        "lpad(CAST(l_linenumber * 4 AS STRING), 2, '0') AS h",
        "lpad(CAST(l_partkey % 60 AS STRING), 2, '0') AS mi",
    )
    with_year = texts.select("l_orderkey", "l_linenumber", obs.four_digit_year("y2").alias("year4"), "m", "d", "h", "mi")
    return with_year.select(
        "l_orderkey", "l_linenumber", "year4", obs.build_timestamp("year4", "m", "d", "h", "mi").alias("datetime")
    )


def schema_drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET1, PRJ2, PRJ3: files with different headers unioned by name; the
    year spelling is coalesced and absent measurements read as NULL."""
    orders = table(spark, sf_dir, "orders").select(
        F.format_string("%05d", F.col("o_custkey")).alias("buoy_id"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("source_stem"),
        F.lit(2).alias("line_no"),
        F.year("o_orderdate").cast("string").alias("yy_hash"),
        F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("month_raw"),
        F.lpad(F.dayofmonth("o_orderdate").cast("string"), 2, "0").alias("day_raw"),
        F.lit("00").alias("hour_raw"),
        F.col("o_totalprice").cast("string").alias("PRES"),
    )
    items = table(spark, sf_dir, "lineitem").select(
        F.format_string("%05d", F.col("l_suppkey")).alias("buoy_id"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.concat(F.lit("l"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("source_stem"),
        F.lit(2).alias("line_no"),
        F.year("l_shipdate").cast("string").alias("yyyy"),
        F.lpad(F.month("l_shipdate").cast("string"), 2, "0").alias("month_raw"),
        F.lpad(F.dayofmonth("l_shipdate").cast("string"), 2, "0").alias("day_raw"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("hour_raw"),
        F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0").alias("minute_raw"),
        F.col("l_quantity").cast("string").alias("WSPD"),
        F.col("l_tax").cast("string").alias("PTDY"),
    )
    union = orders.unionByName(items, allowMissingColumns=True)
    typed = obs.normalize(union)
    return typed.select(
        "source_stem", "buoy_id", "datetime", "pressure", "wind_speed", "pressure_tendency", "tide"
    )


def partition_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2, AGG1, DT1: rows admitted into / rejected from their year, after
    the year-scoped dedup. Every tenth order is misfiled into the next
    year's directory; urgent pending orders carry a corrupt hour."""
    o = table(spark, sf_dir, "orders")
    corrupt = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    load_year = (F.year("o_orderdate") + F.when(F.col("o_orderkey") % 10 == 0, 1).otherwise(0)).cast("string")
    typed = o.select(
        F.format_string("%05d", F.col("o_custkey")).alias("buoy_id"),
        F.when(~corrupt, F.col("o_orderdate").cast("timestamp_ntz")).alias("datetime"),
        load_year.alias("load_year"),
        F.format_string("%012d", F.col("o_orderkey")).alias("source_stem"),
        F.lit(2).alias("line_no"),
    )
    deduped = obs.dedup_keep_first(typed, ["load_year"])
    return admission.admission_counts(deduped)


def year_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3: ``count:newest-mtime`` per year, ``empty`` for a year without files."""
    o = table(spark, sf_dir, "orders")
    inv = derived.file_inventory_from_orders(o)
    bounds = o.agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"))
    years = bounds.select(F.explode(F.sequence("lo", F.col("hi") + 1)).alias("y")).select(
        F.col("y").cast("string").alias("year")
    )
    return incremental.year_fingerprints(inv, years)


_ORDERS_YEAR_TEXT = (
    "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'unknown' "
    "ELSE CAST(year(o_orderdate) AS STRING) END"
)


def changed_years(spark: SparkSession, sf_dir: str, force: bool = False) -> DataFrame:
    """JOIN2, FLT3, FLT5, SORT1: years to rebuild. The ledger holds the
    fingerprints of the bronze as it stood before the cut-off (each behind
    an older, stale row); the current bronze is the whole table."""
    o = table(spark, sf_dir, "orders")
    inv = derived.file_inventory_from_orders(o, _ORDERS_YEAR_TEXT)
    current = incremental.year_fingerprints(inv)
    old_inv = derived.file_inventory_from_orders(o.where(F.col("o_orderdate") < F.lit(LEDGER_CUTOFF)), _ORDERS_YEAR_TEXT)
    old = incremental.year_fingerprints(old_inv).where(incremental.is_loadable_year("year"))
    ledger = old.select(
        F.col("year").cast("int").alias("year"), "bronze_fingerprint",
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"), F.lit("r2").alias("run_token"),
    ).unionByName(old.select(
        F.col("year").cast("int").alias("year"), F.lit("stale").alias("bronze_fingerprint"),
        F.lit("1999-01-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"), F.lit("r1").alias("run_token"),
    ))
    latest = monitoring.ledger_latest(ledger)
    return incremental.changed_years(current, latest, force=force).select("year", "bronze_fingerprint", "reason").orderBy("year")


def changed_years_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT5: with ``force`` every loadable year is rebuilt, whatever the ledger says."""
    return changed_years(spark, sf_dir, force=True)


def _links_and_cache(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    raw = derived.download_links_from_orders(o)
    rewritten = raw.select("buoy_id", links.text_view_link("url").alias("url"))
    return links.with_source_identity(rewritten, "url"), derived.bronze_cache_from_orders(o)


def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN3, FLT4, SET2: download links minus closed, readable years
    already in bronze; each URL once."""
    wanted, cache = _links_and_cache(spark, sf_dir)
    return incremental.fetch_plan(wanted, cache, ORDERS_AS_OF_YEAR).select("buoy_id", "year", "source_stem", "url")


def fetch_plan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT5: a full refresh fetches every link, cached or not."""
    wanted, cache = _links_and_cache(spark, sf_dir)
    return incremental.fetch_plan(wanted, cache, ORDERS_AS_OF_YEAR, full_refresh=True).select("buoy_id", "year", "source_stem", "url")


def fetch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9: links seen, skipped as already cached, left to fetch."""
    wanted, cache = _links_and_cache(spark, sf_dir)
    return incremental.fetch_counts(wanted, cache, ORDERS_AS_OF_YEAR)


def source_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR7: (source stem, year) from every event's download link."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    buoy = F.format_string("%05d", F.col("user_id"))
    y = F.year("ts").cast("string")
    url = (
        F.when(eid % 5 == 0, F.concat(F.lit("/view_text_file.php?dir=data/historical/stdmet/&ref="), eid.cast("string")))
        .when(eid % 5 == 1, F.concat(F.lit("/view_text_file.php?filename="), buoy, F.lit("h"), y, F.lit("%2Etxt%2Egz&dir=x")))
        .when(eid % 5 == 2, F.concat(F.lit("/view_text_file.php?filename="), buoy, F.lit(".txt.gz")))
        .otherwise(F.concat(F.lit("/view_text_file.php?filename="), buoy, F.lit("h"), y, F.lit(".txt.gz&dir=data/historical/stdmet/")))
    )
    return ev.select("event_id", url.alias("url")).select(
        "event_id", "url", links.source_stem("url").alias("source_stem"), links.source_year("url").alias("year")
    )


NAV_LIST_PATTERN = r"(?s)<nav[^>]*>\s*<ul[^>]*>(.*?)</ul>"


def page_links_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6, STR4-STR6, STR8, SET2: list links of every landed page, one row
    per distinct link (kept from the lowest page id)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    exploded = links.explode_list_links(pages, NAV_LIST_PATTERN, keep=["page_id"])
    # Navigation items carry no station label; the page itself is the station.
    named = exploded.withColumn(
        "buoy_id", F.coalesce("buoy_id", F.format_string("%05d", F.col("page_id")))
    ).withColumn("station_url", links.station_page_url("buoy_id"))
    unique = stations.distinct_by_url(named, "link", order_cols=["page_id", "item_pos", "link_pos"])
    return unique.select("link", "page_id", "item_pos", "buoy_id", "source_stem", "year", "station_url")


def coordinate_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1-STR3: position and status from each landed station page."""
    pages = derived.station_pages_from_customer(table(spark, sf_dir, "customer"))
    return coords.positions_from_pages(pages)


def dimension_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2: one coordinate row per station, first non-NULL value per column."""
    raw = derived.coordinate_rows_from_supplier(table(spark, sf_dir, "supplier"))
    return stations.collapse_coordinates(raw, "path")


def fact_with_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN1: clean observations (flagship transform) with station position."""
    observations = obs.clean_observations(_bronze_from_events(spark, sf_dir))
    positions = coords.positions_from_pages(derived.station_pages_from_customer(table(spark, sf_dir, "customer")))
    return stations.with_position(observations, positions)


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.runs_from_events(table(spark, sf_dir, "events"))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4, DT2: newest observation and its age at the fixed clock."""
    ev = table(spark, sf_dir, "events").select(F.col("ts").alias("datetime"))
    return monitoring.freshness(ev, EVENTS_AS_OF)


def latest_run_per_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN2: latest run of each stage."""
    runs = _runs(spark, sf_dir).select("stage", "run_token", "status", "started_at", "finished_at")
    return monitoring.latest_run_per_stage(runs)


def stuck_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5, DT3: per stage, runs, stuck runs and the longest finished run."""
    runs = _runs(spark, sf_dir)
    dur = monitoring.duration_seconds(F.col("started_at"), F.col("finished_at"))
    return runs.groupBy("stage").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(monitoring.is_stuck("2024-01-20 00:00:00")).alias("stuck_runs"),
        F.max(dur).alias("max_duration_sec"),
    )


def last_ten_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP1: the ten newest runs with their duration."""
    return monitoring.last_runs(_runs(spark, sf_dir), 10)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.ledger_from_orders(table(spark, sf_dir, "orders"))


def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5 read side: the current ledger row per year."""
    return monitoring.ledger_latest(_ledger(spark, sf_dir))


def rejects_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT6: current years with rejected rows, in year order."""
    return monitoring.rejects_report(monitoring.ledger_latest(_ledger(spark, sf_dir)))


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7: loaded, rejected and years per run."""
    return monitoring.run_counters(_ledger(spark, sf_dir))


def partition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG6: published year partitions."""
    return monitoring.partition_count(monitoring.ledger_latest(_ledger(spark, sf_dir)))


def health_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MON1, MON2: one row per problem at the fixed clock."""
    ev = table(spark, sf_dir, "events").select(F.col("ts").alias("datetime"))
    ledger_current = monitoring.ledger_latest(_ledger(spark, sf_dir))
    return monitoring.health_report(spark, ev, _runs(spark, sf_dir), ledger_current, EVENTS_AS_OF)


def integrity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CHK1-CHK4 over orders and lineitem: violations per check."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    joined = li.select("l_orderkey", "l_shipdate").join(
        o.select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("order_year")), "l_orderkey"
    )
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "running").otherwise("pending")
    report = checks.unique_check(o, ["o_custkey", "o_orderdate"])
    report = report.unionByName(checks.not_null_check(li, ["l_orderkey", "l_shipdate"]))
    report = report.unionByName(checks.year_range_check(joined, F.col("l_shipdate").cast("timestamp_ntz"), F.col("order_year")))
    return report.unionByName(checks.status_check(o, status))


def decode_edge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1, PRJ3, PRJ4: missing-value words in date fields, short lines,
    over-long lines (flagged), repeated header names (the first counts)."""
    decoded = decode_station_text(derived.odd_station_text_from_orders(table(spark, sf_dir, "orders")))
    typed = obs.normalize(decoded).select("source_stem", "datetime", "wind_direction", "wind_speed", F.lit(False).alias("flagged"))
    flagged = decoded.where(F.col("decode_error").isNotNull()).select("source_stem", F.lit(True).alias("flagged"))
    return typed.unionByName(flagged, allowMissingColumns=True)


def archive_index_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4-STR8: index pages with two lists, white space around ids, escaped
    links and both kinds of quotes."""
    pages = derived.index_pages_from_orders(table(spark, sf_dir, "orders"))
    return links.explode_archive_index(pages).select("buoy_id", "year", "source_stem", "link")


def error_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR9: NUL characters removed, then clipped to the log's length (the operator's limit)."""
    dirty = F.concat(F.lit("\u0000"), F.replace("text", F.lit("e"), F.lit("e\u0000")))
    return table(spark, sf_dir, "documents").select("doc_id", monitoring.clip_error(dirty).alias("error"))


def run_stats_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON1: run statistics as JSON text."""
    per_user = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("newest"))
    stats = F.create_map(F.lit("events"), F.col("n").cast("string"), F.lit("newest_event"), F.col("newest").cast("string"))
    return per_user.select("user_id", monitoring.stats_json(stats).alias("stats"))


def dimension_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8: stations of the reloaded dimension."""
    return admission.dimension_count(dimension_collapse(spark, sf_dir))


def page_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9: station pages seen, without and with an unreadable position."""
    return coordinate_parse(spark, sf_dir).agg(*[c.alias(k) for k, c in stations.page_counters().items()])


def committed_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3 over commits (SRC7): the source versions of 16 ingest batches are committed but for
    every fifth batch, whose files lie there without a manifest; fingerprints per year."""
    root, orders = paths.scratch_root(spark, "fingerprints"), table(spark, sf_dir, "orders")
    versions = orders.selectExpr(
        "format_string('%05d', o_custkey) AS buoy_id", f"{_ORDERS_YEAR_TEXT} AS year",
        f"concat(format_string('%05d', o_custkey), 'h', {_ORDERS_YEAR_TEXT}) AS source_stem",
        "0L AS lines_flagged", "format_string('%020d-orders', o_orderkey % 16) AS batch", "o_orderkey % 16 AS k",
    )
    files = versions.select("buoy_id", "source_stem", "year", "batch").distinct()
    files.write.partitionBy("batch", "year").parquet(bronze.observations_path(root))
    committed = versions.where("k % 5 <> 4").drop("k").distinct()
    committed.write.partitionBy("batch").parquet(bronze.manifests_path(root))
    held = bronze.read_manifests(spark, root, batches=bronze.committed_batches(spark, root))
    return incremental.committed_fingerprints(held)


def _versions(spark: SparkSession, sf_dir: str) -> str:
    """Bronze written three times: everything; all sources of 1999 and later again; every second
    source of 1998 again. The later versions lack the rows of hours 0 to 5."""
    root, rows = paths.scratch_root(spark, "bronze"), derived.bronze_rows_from_orders(table(spark, sf_dir, "orders"))
    write_bronze_frame(rows, root)
    for where in ("year >= '1999'", "year = '1998' AND CAST(buoy_id AS INT) % 2 = 0"):
        write_bronze_frame(derived.refetched_rows(rows, where, "hour_raw < '06'"), root)
    return root


def bronze_current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2, SNK1: bronze written, written again and read: each source's newest version,
    whose folders the manifests choose."""
    current = bronze.read_bronze_observations(spark, _versions(spark, sf_dir))
    return current.select("buoy_id", "year", "source_stem", "line_no", "hour_raw", "PRES")


def bronze_vacuumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2 after clean-up: folders whose sources were all replaced are deleted; rows per year and
    the folders that stay are counted."""
    root = _versions(spark, sf_dir)
    bronze.vacuum_bronze(spark, root, grace_hours=0.0, now=dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1))
    rows = bronze.read_bronze_observations(spark, root).groupBy("year").agg(F.count(F.lit(1)).alias("row_count"))
    folders = bronze.bronze_inventory(spark, root).select("year", "batch").distinct().groupBy("year").agg(F.count(F.lit(1)).alias("folders"))
    return rows.join(folders, "year")


def silver_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4, SNK5, SRC9, AGG3, JOIN2: a full load, two later ingests, a load of what changed; the
    published rows as the ledger then names them."""
    root, silver_root = paths.scratch_root(spark, "bronze"), paths.scratch_root(spark, "silver")
    rows = derived.bronze_rows_from_orders(table(spark, sf_dir, "orders"))
    write_bronze_frame(rows, root)
    run_silver(spark, root, silver_root)
    write_bronze_frame(derived.refetched_rows(rows, "year >= '2000'", "hour_raw < '06'"), root)
    run_silver(spark, root, silver_root)
    return silver.read_published_observations(spark, silver_root).select("buoy_id", "datetime", "pressure")


#: Station and instants of the registered window read.
WINDOW_STATION, WINDOW = "00007", (dt.datetime(1996, 3, 1), dt.datetime(1999, 9, 1))


def station_window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC9: one station and a span of time out of a whole publish; the file index chooses the files."""
    root, silver_root = paths.scratch_root(spark, "bronze"), paths.scratch_root(spark, "silver")
    write_bronze_frame(derived.bronze_rows_from_orders(table(spark, sf_dir, "orders")), root)
    run_silver(spark, root, silver_root)
    found = silver.read_published_observations(spark, silver_root, start=WINDOW[0], end=WINDOW[1], buoy_id=WINDOW_STATION)
    return found.select("buoy_id", "datetime", "pressure")


def _configured(fn: Query) -> Query:
    """Every query runs under the engine's session settings (UTC clock,
    text partition values, AQE)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


_REGISTRY: dict[str, Query] = {
    "station_text_decode": station_text_decode,
    "sentinel_nullify": sentinel_nullify,
    "dedup_keep_first": dedup_keep_first,
    "year_pivot": year_pivot,
    "schema_drift_union": schema_drift_union,
    "partition_admission": partition_admission,
    "year_fingerprint": year_fingerprint,
    "changed_years": changed_years,
    "fetch_plan": fetch_plan,
    "fetch_counts": fetch_counts,
    "source_identity": source_identity,
    "page_links_explode": page_links_explode,
    "coordinate_parse": coordinate_parse,
    "dimension_collapse": dimension_collapse,
    "fact_with_position": fact_with_position,
    "freshness": freshness,
    "latest_run_per_stage": latest_run_per_stage,
    "stuck_runs": stuck_runs,
    "last_ten_runs": last_ten_runs,
    "ledger_latest": ledger_latest,
    "rejects_report": rejects_report,
    "run_counters": run_counters,
    "partition_count": partition_count,
    "health_report": health_report,
    "integrity_checks": integrity_checks,
    "decode_edge_cases": decode_edge_cases,
    "archive_index_parse": archive_index_parse,
    "changed_years_forced": changed_years_forced,
    "fetch_plan_full": fetch_plan_full,
    "error_clip": error_clip,
    "run_stats_json": run_stats_json,
    "dimension_count": dimension_count,
    "page_counters": page_counters,
    "committed_fingerprint": committed_fingerprint,
    "bronze_current_versions": bronze_current_versions,
    "bronze_vacuumed": bronze_vacuumed,
    "silver_reload": silver_reload,
    "station_window_read": station_window_read,
}

QUERIES: dict[str, Query] = {name: _configured(fn) for name, fn in _REGISTRY.items()}
