"""Station-shaped inputs derived by Spark from the driver's tables.

The test tables hold no station records, so the registered queries derive
them: landed station text from ``events``, station pages from ``customer``,
download links from ``orders``. Each derivation is a DataFrame plan over the
whole table, so the work grows with the table.

Landed text: one file per (buoy, year, id block). A buoy is
``user_id`` zero-padded to at least five digits (never truncated);
``event_id div FILE_BLOCK`` is the block, so no
file ever holds more than ``FILE_BLOCK`` lines however skewed the users are.
Within a file lines follow ``event_id``; block numbers are zero-padded so
stem order equals id order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import sql

FILE_BLOCK = 65536

# Header layout per buoy, by ``user_id % 4``: 0 -> "#YY" with minute,
# 1 -> "YYYY" with minute and the newer PTDY column, 2 -> two-digit "YY",
# 3 -> "#YY" without a minute column.
_UNITS = {
    "#YY": "#yr",
    "YYYY": "yr",
    "YY": "yr",
}


def _tenths_sql(expr: str) -> str:
    """Non-negative integer tenths -> text such as ``12.3``."""
    return f"concat(CAST(({expr}) DIV 10 AS STRING), '.', CAST(({expr}) % 10 AS STRING))"


def event_station_lines(events: DataFrame) -> DataFrame:
    """One text line per event plus its file coordinates.

    Rows are hash-partitioned by file right after the scan (cheap key
    columns only), so the text formatting runs after the exchange, in
    parallel, and the per-file grouping that follows reuses this
    partitioning instead of shuffling again.
    """
    buoy = "format_string('%05d', user_id)"
    year = "CAST(year(ts) AS STRING)"
    block = f"format_string('%010d', event_id DIV {FILE_BLOCK})"
    keyed = events.selectExpr(
        f"{buoy} AS buoy_id",
        f"{year} AS year",
        f"concat({buoy}, 'h', {year}, 'b', {block}) AS source_stem",
        "user_id % 4 AS variant",
        "event_id", "ts", "value",
    ).repartition("buoy_id", "year", "source_stem", "variant")
    two = lambda e: f"lpad(CAST({e} AS STRING), 2, '0')"
    year_text = f"CASE WHEN variant = 2 THEN {two('year(ts) % 100')} ELSE CAST(year(ts) AS STRING) END"
    date_fields = [year_text, two("month(ts)"), two("day(ts)"), two("hour(ts)")]
    minute = two("(minute(ts) DIV 30) * 30")
    wdir = "CASE WHEN event_id % 7 = 0 THEN '999' ELSE lpad(CAST(event_id % 360 AS STRING), 3, '0') END"
    wspd = f"format_string('%5s', CASE WHEN event_id % 11 = 0 THEN '99.0' ELSE {_tenths_sql('event_id % 250')} END)"
    gst = f"CASE WHEN event_id % 13 = 0 THEN 'MM' ELSE {_tenths_sql('event_id % 300')} END"
    pres = f"format_string('%7s', CASE WHEN event_id % 17 = 0 THEN '9999.0' ELSE {_tenths_sql('9500 + event_id % 700')} END)"
    atmp = "CASE WHEN event_id % 19 = 0 THEN '999.0' ELSE CAST(value AS STRING) END"
    ptdy = f"CASE WHEN event_id % 23 = 0 THEN '99.0' ELSE {_tenths_sql('event_id % 50')} END"
    tide = f"CASE WHEN event_id % 29 = 0 THEN '99.00' ELSE {_tenths_sql('event_id % 30')} END"
    # Layout by variant: minute column absent for 3, PTDY present for 1.
    minute_part = f"CASE WHEN variant = 3 THEN NULL ELSE {minute} END"
    ptdy_part = f"CASE WHEN variant = 1 THEN {ptdy} END"
    line = f"concat_ws(' ', {', '.join(date_fields)}, {minute_part}, {wdir}, {wspd}, {gst}, {pres}, {atmp}, {ptdy_part}, {tide})"
    return keyed.selectExpr("buoy_id", "year", "source_stem", "variant", "event_id", f"{line} AS line")


def _header_and_units(variant: Column) -> tuple[Column, Column]:
    def pair(year_head: str, minute: bool, ptdy: bool) -> tuple[str, str]:
        heads = [year_head, "MM", "DD", "hh"] + (["mm"] if minute else [])
        units = [_UNITS[year_head], "mo", "dy", "hr"] + (["mn"] if minute else [])
        heads += ["WDIR", "WSPD", "GST", "PRES", "ATMP"] + (["PTDY"] if ptdy else []) + ["TIDE"]
        units += ["degT", "m/s", "m/s", "hPa", "degC"] + (["hPa"] if ptdy else []) + ["ft"]
        return " ".join(heads), " ".join(units)

    layouts = {0: pair("#YY", True, False), 1: pair("YYYY", True, True), 2: pair("YY", True, False), 3: pair("#YY", False, False)}
    header = F.lit(layouts[0][0])
    units = F.lit(layouts[0][1])
    for k in (1, 2, 3):
        header = F.when(variant == k, F.lit(layouts[k][0])).otherwise(header)
        units = F.when(variant == k, F.lit(layouts[k][1])).otherwise(units)
    return header, units


def station_text_from_events(events: DataFrame) -> DataFrame:
    """Landed station files ``(buoy_id, year, source_stem, value)``.

    Grouping is by file; a file is bounded by ``FILE_BLOCK`` lines, so the
    collected list per group is bounded too. Lines are ordered by event id
    inside the file (``array_sort`` of (id, line) structs), independent of
    shuffle arrival order.
    """
    lines = event_station_lines(events)
    files = lines.groupBy("buoy_id", "year", "source_stem", "variant").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "line"))).alias("entries")
    )
    header, units = _header_and_units(F.col("variant"))
    body = F.concat_ws("\n", F.transform("entries", lambda s: s["line"]))
    return files.select(
        "buoy_id",
        "year",
        "source_stem",
        F.concat(header, F.lit("\n"), units, F.lit("\n"), body, F.lit("\n")).alias("value"),
    )


def _fixed3_sql(expr: str) -> str:
    """Non-negative integer thousandths -> text such as ``48.126``."""
    return f"concat(CAST(({expr}) DIV 1000 AS STRING), '.', lpad(CAST(({expr}) % 1000 AS STRING), 3, '0'))"


def station_pages_from_customer(customer: DataFrame) -> DataFrame:
    """One landed station page per customer ``(buoy_id, html)``.

    The position text sits in bold item 4, 3, 2 or 5 of the first metadata
    paragraph (``c_custkey % 7`` = 0..3), or is absent (4), integers only
    (5) or an empty item 5 (6). A second paragraph carries a decoy position
    that must never be read.
    """
    lat, lon = "(c_custkey * 37) % 90000", "(c_custkey * 53) % 180000"
    ns = "CASE WHEN c_nationkey % 2 = 0 THEN 'N' ELSE 'S' END"
    ew = "CASE WHEN c_nationkey % 3 = 0 THEN 'E' ELSE 'W' END"
    dms = (
        f"concat('(', CAST(({lat}) DIV 1000 AS STRING), '°', CAST(({lat}) % 60 AS STRING), "
        f"{sql.literal(chr(39) + ' ')}, {ns}, ')')"
    )
    coord = f"concat_ws(' ', {_fixed3_sql(lat)}, {ns}, {_fixed3_sql(lon)}, {ew}, {dms})"
    integers = f"concat_ws(' ', CAST(({lat}) DIV 1000 AS STRING), {ns}, CAST(({lon}) DIV 1000 AS STRING), {ew})"
    case = "c_custkey % 7"
    b1 = "concat('Owned and maintained by ', c_name)"
    b2 = f"CASE WHEN {case} = 2 THEN {coord} ELSE concat('Station ', CAST(c_custkey AS STRING)) END"
    b3 = f"CASE WHEN {case} = 1 THEN {coord} ELSE c_mktsegment END"
    b4 = f"CASE WHEN {case} = 0 THEN {coord} ELSE concat('Site elevation: ', CAST(c_custkey % 50 AS STRING), ' m') END"
    b5 = (
        f"CASE WHEN {case} = 3 THEN {coord} WHEN {case} = 5 THEN {integers} WHEN {case} = 6 THEN '' "
        f"ELSE concat('Water depth: ', CAST(c_custkey % 4000 AS STRING), ' m') END"
    )

    def bold(e: str) -> str:
        return f"concat('<b>', {e}, '</b><br>')"

    items = f"concat({bold(b1)}, {bold(b2)}, {bold(b3)}, {bold(b4)}, CASE WHEN {case} = 4 THEN '' ELSE {bold(b5)} END)"
    head = sql.literal('</h1><div id="stn_metadata"><p>')
    tail = sql.literal("</p><p><b>10.500 N 20.250 W</b></p></div></body></html>")
    html = f"concat('<html><body><h1>Station ', CAST(c_custkey AS STRING), {head}, {items}, {tail})"
    return customer.selectExpr("format_string('%05d', c_custkey) AS buoy_id", f"{html} AS html")



_ORDER_BUOY = "format_string('%05d', o_custkey)"
_ORDER_YEAR = "CAST(year(o_orderdate) AS STRING)"


def download_links_from_orders(orders: DataFrame) -> DataFrame:
    """Archive download links ``(buoy_id, url)``, one per order: the file of
    the customer's order year. Urgent pending orders get a link without a
    ``filename`` parameter (an unknown year)."""
    odd = "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
    return orders.selectExpr(
        f"{_ORDER_BUOY} AS buoy_id",
        f"CASE WHEN {odd} THEN concat('/historical_data/download_data.php?dir=data/historical/stdmet/&ref=', "
        f"CAST(o_orderkey AS STRING)) ELSE concat('/historical_data/download_data.php?filename=', {_ORDER_BUOY}, "
        f"'h', {_ORDER_YEAR}, '.txt.gz&dir=data/historical/stdmet/') END AS url",
    )


def bronze_cache_from_orders(orders: DataFrame) -> DataFrame:
    """Bronze files already on disk ``(buoy_id, year, source_stem, usable)``:
    fulfilled orders' (customer, year) files; a file holding any low-priority
    order is unreadable."""
    return (
        orders.where("o_orderstatus = 'F'")
        .selectExpr(f"{_ORDER_BUOY} AS buoy_id", f"{_ORDER_YEAR} AS year", "o_orderpriority <> '5-LOW' AS ok")
        .groupBy("buoy_id", "year")
        .agg(F.bool_and("ok").alias("usable"))
        .withColumn("source_stem", F.concat("buoy_id", F.lit("h"), "year"))
    )


def file_inventory_from_orders(orders: DataFrame, year_sql: str = _ORDER_YEAR) -> DataFrame:
    """Bronze file inventory ``(path, buoy_id, year, modificationTime)``:
    one file per order, modified ``o_orderkey % 86400`` seconds after the
    order date. ``year_sql`` is the SQL text of the hive year."""
    return orders.selectExpr(
        f"concat('observations/buoy_id=', {_ORDER_BUOY}, '/year=', {year_sql}, '/', "
        "CAST(o_orderkey AS STRING), '.parquet') AS path",
        f"{_ORDER_BUOY} AS buoy_id",
        f"{year_sql} AS year",
        "timestamp_micros(unix_micros(CAST(o_orderdate AS TIMESTAMP)) + (o_orderkey % 86400) * 1000000) AS modificationTime",
    )


def ledger_from_orders(orders: DataFrame) -> DataFrame:
    """Append-only year ledger: one row per order, run = status-priority."""
    return orders.selectExpr(
        "year(o_orderdate) AS year",
        "concat('fp-', CAST(o_custkey AS STRING)) AS bronze_fingerprint",
        "o_orderkey % 1000 AS rows_loaded",
        "CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey % 5 ELSE CAST(0 AS BIGINT) END AS rows_rejected",
        # Zone-less arithmetic: the same instant whatever the session zone.
        "CAST(o_orderdate AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, CAST(o_orderkey % 86400 AS DECIMAL(18, 6))) AS loaded_at",
        "concat(o_orderstatus, '-', o_orderpriority) AS run_token",
    )


def runs_from_events(events: DataFrame) -> DataFrame:
    """Run log rows, one per event. ``view`` events are scrape runs, ``error``
    events silver runs; every ninth run is still running; a run whose crawl
    ended for any reason but ``finished`` failed."""
    from tidewater.operators.monitoring import run_status_from_reason

    base = events.selectExpr(
        "concat('run-', format_string('%010d', event_id)) AS run_token",
        "CASE event_type WHEN 'view' THEN 'scrape' WHEN 'error' THEN 'silver' ELSE event_type END AS stage",
        "event_id % 9 = 0 AS _running",
        "CASE WHEN value < 50 THEN 'shutdown' ELSE 'finished' END AS _reason",
        "CAST(ts AS TIMESTAMP_NTZ) AS started_at",
        "CASE WHEN event_id % 9 <> 0 THEN CAST(ts AS TIMESTAMP_NTZ) "
        "+ make_dt_interval(0, 0, 0, CAST(event_id % 3600 AS DECIMAL(18, 6))) END AS finished_at",
        "event_id % 1000 AS rows_loaded",
        "CAST(user_id % 5 AS INT) AS years_loaded",
        "event_id % 7 AS rows_rejected",
    )
    status = F.when(F.col("_running"), F.lit("running")).otherwise(run_status_from_reason(F.col("_reason")))
    return base.select(
        "run_token", "stage", status.alias("status"), "started_at", "finished_at",
        "rows_loaded", "years_loaded", "rows_rejected",
    )


def coordinate_rows_from_supplier(supplier: DataFrame) -> DataFrame:
    """Bronze coordinate rows ``(buoy_id, path, latitude, longitude)``: one
    per supplier, grouped into stations by nation, with NULLs injected."""
    return supplier.selectExpr(
        "format_string('%05d', s_nationkey) AS buoy_id",
        "concat('coordinates/buoy_id=', format_string('%05d', s_nationkey), '/part-', "
        "format_string('%08d', s_suppkey), '.parquet') AS path",
        "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal / 100 END AS latitude",
        "CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE CAST(s_suppkey AS DOUBLE) / 10 END AS longitude",
    )


def odd_station_text_from_orders(orders: DataFrame) -> DataFrame:
    """Landed station files, one per order, each with a trap (``o_orderkey % 5``):
    a missing-value word as minute, a short line, an over-long line, a repeated
    header name, a missing-value word in the first spelling of the year."""
    day = "date_format(o_orderdate, 'MM dd')"
    year = "CAST(year(o_orderdate) AS STRING)"
    wdir, wspd = "CAST(o_custkey % 360 AS STRING)", "CAST(o_orderkey % 60 AS STRING)"
    plain = ("#YY MM DD hh mm WDIR WSPD", "#yr mo dy hr mn degT m/s")
    layouts = [
        (*plain, f"{year}, {day}, '05', 'NA', {wdir}, {wspd}"),
        (*plain, f"{year}, {day}, '05', '30', {wdir}"),
        (*plain, f"{year}, {day}, '05', '30', {wdir}, {wspd}, '7'"),
        ("#YY MM DD hh mm WDIR WDIR WSPD", "#yr mo dy hr mn degT degT m/s", f"{year}, {day}, '05', '30', {wdir}, '1', {wspd}"),
        ("#YY YYYY MM DD hh mm WDIR WSPD", "#yr yr mo dy hr mn degT m/s", f"'null', {year}, {day}, '05', '30', {wdir}, {wspd}"),
    ]
    cases = " ".join(
        f"WHEN {k} THEN concat({sql.literal(head)}, '\\n', {sql.literal(units)}, '\\n', concat_ws(' ', {line}), '\\n')"
        for k, (head, units, line) in enumerate(layouts)
    )
    return orders.selectExpr(
        "format_string('%05d', o_custkey) AS buoy_id",
        f"{year} AS year",
        "concat('e', CAST(o_orderkey AS STRING)) AS source_stem",
        f"CASE o_orderkey % 5 {cases} END AS value",
    )


#: Stations of one derived index page.
INDEX_BLOCK = 50


def index_pages_from_orders(orders: DataFrame) -> DataFrame:
    """Archive index pages ``(url, html)`` over all (customer, order year)
    pairs, ``INDEX_BLOCK`` stations a page: even stations in a list before the anchor, odd
    ones in a list behind it and a heading, white space around ids, escaped links, both quote
    kinds and none, tags in capitals, items without an end tag, a list within a comment
    and a list of another section that don't belong."""
    pairs = orders.selectExpr("o_custkey AS station", "year(o_orderdate) AS y").distinct()
    buoy = "format_string('%05d', station)"
    href = f"concat('/download_data.php?dir=d/&amp;filename=', {buoy}, 'h', CAST(y AS STRING), '&#46;txt.gz')"
    link = f"CASE WHEN y % 2 = 0 THEN concat('<a href=\"', {href}, '\">', y, '</a>') ELSE concat('<a class=z href=\\'', {href}, '\\'>', y, '</a>') END"
    items = pairs.selectExpr("station", f"{link} AS link").groupBy("station").agg(F.concat_ws(" ", F.sort_array(F.collect_list("link"))).alias("links"))
    item = items.selectExpr(
        f"station DIV {INDEX_BLOCK} AS page", "station % 2 AS odd",
        f"concat(CASE WHEN station % 4 = 1 THEN '<LI>' ELSE '<li>' END, '\\n\\t ', {buoy}, ': ', links, CASE WHEN station % 4 < 2 THEN '</li>' ELSE '' END) AS item",
    )
    lists = item.groupBy("page").agg(*[F.concat_ws("\n", F.sort_array(F.collect_list(F.when(F.col("odd") == k, F.col("item"))))).alias(f"list{k}") for k in (0, 1)])
    return lists.selectExpr(
        "concat('https://example.org/index/', page) AS url",
        "concat('<DIV><!-- <ul class=\"histfiles\"><li>88888: <a href=\"/q?filename=zh1988.txt.gz\">1988</a></li></ul> -->"
        "<UL CLASS=histfiles>', list0, '</UL><A class=c id=\\'stdmet\\'>x</A><h3>Years</h3><p>and<ul class=\\'histfiles\\'>', list1, "
        "'</ul></DIV><div><a id=\"other\">y</a><ul class=\"histfiles\"><li>99999: <a href=\"/q?filename=zh1999.txt.gz\">1999</a></li></ul></div>') AS html",
    )


def bronze_rows_from_orders(orders: DataFrame) -> DataFrame:
    """Bronze-shaped rows, one per order: a customer's orders of a year are one source."""
    return orders.selectExpr(
        f"{_ORDER_BUOY} AS buoy_id",
        f"concat({_ORDER_BUOY}, 'h', {_ORDER_YEAR}) AS source_stem",
        "CAST(row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) AS INT) AS line_no",
        f"{_ORDER_YEAR} AS yyyy",
        "date_format(o_orderdate, 'MM') AS month_raw",
        "date_format(o_orderdate, 'dd') AS day_raw",
        "lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') AS hour_raw",
        "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING) AS PRES",
        f"{_ORDER_YEAR} AS year",
    )


def refetched_rows(rows: DataFrame, where: str, drop: str) -> DataFrame:
    """The sources chosen by ``where``, fetched again without the rows of ``drop``."""
    return rows.where(where).where(f"NOT ({drop})")
