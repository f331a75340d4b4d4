"""Column functions for archive links and landed pages (all built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import html, sql
from tidewater.schema import (
    DOWNLOAD_PATH_TOKEN,
    FILENAME_SUFFIX_PATTERN,
    FILENAME_YEAR_PATTERN,
    STATION_PAGE_URL,
    TEXT_VIEW_PATH_TOKEN,
)


def _lit(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fname_sql(url: str) -> str:
    """Decoded ``filename`` query parameter; NULL when absent or empty.
    ``try_parse_url`` accepts relative links and yields NULL for a
    malformed URL instead of failing the job."""
    raw = f"try_parse_url({url}, 'QUERY', 'filename')"
    return f"nullif(coalesce(try_url_decode({raw}), {raw}), '')"


def _stem_sql(url: str, fname: str) -> str:
    return (
        f"coalesce(regexp_replace({fname}, {sql.literal(FILENAME_SUFFIX_PATTERN)}, ''), "
        f"concat('unknown-', substring(sha1(encode({url}, 'UTF-8')), 1, 12)))"
    )


def _year_sql(fname: str) -> str:
    year = f"regexp_extract(coalesce({fname}, ''), {sql.literal(FILENAME_YEAR_PATTERN)}, 1)"
    return f"CASE WHEN {year} <> '' THEN {year} ELSE 'unknown' END"


def source_stem(url_col: str) -> Column:
    """``filename`` without ``.txt.gz``; else ``unknown-`` + 12 hex of SHA-1(url)."""
    url = sql.ident(url_col)
    return F.expr(_stem_sql(url, _fname_sql(url)))


def source_year(url_col: str) -> Column:
    """Four-digit year from ``h<yyyy>.txt`` in the file name, else ``unknown``."""
    return F.expr(_year_sql(_fname_sql(sql.ident(url_col))))


def with_source_identity(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``source_stem`` and ``year`` derived from ``url_col`` (the rules
    of ``source_stem`` / ``source_year``, in two projections so the query
    parameter is parsed once per row)."""
    url = sql.ident(url_col)
    with_name = df.selectExpr("*", f"{_fname_sql(url)} AS _fname")
    keep = [sql.ident(c) for c in df.columns if c not in ("source_stem", "year")]
    return with_name.selectExpr(
        *keep, f"{_stem_sql(url, '_fname')} AS source_stem", f"{_year_sql('_fname')} AS year"
    )


def text_view_link(link: Column | str) -> Column:
    """Download link -> plain-text view link."""
    return F.replace(_lit(link), F.lit(DOWNLOAD_PATH_TOKEN), F.lit(TEXT_VIEW_PATH_TOKEN))


def strip(text: Column | str) -> Column:
    """Without white space of any kind at both ends (``trim`` knows spaces only)."""
    return F.regexp_replace(_lit(text), r"^\s+|\s+$", "")


def clean_buoy_id(text: Column | str) -> Column:
    """Strip, then drop every ``:``; NULL stays NULL (reported by the caller)."""
    return F.replace(strip(text), F.lit(":"), F.lit(""))


#: The five entities that every HTML text may hold (ampersand last).
_ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}


def unescape(text: Column | str) -> Column:
    """Numeric character references and the five basic entities decoded."""
    plain = _lit(text)
    return F.when(plain.contains("&"), _unescaped(plain)).otherwise(plain)


def _unescaped(out: Column) -> Column:
    numeric = F.array_distinct(F.regexp_extract_all(out, F.lit(r"(&#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});)"), F.lit(1)))

    def decoded(ref: Column) -> Column:
        digits = F.regexp_replace(ref, r"^&#[xX]?|;$", "")
        in_hex = F.when(ref.rlike("^&#[xX]"), F.upper(digits)).otherwise(F.conv(digits, 10, 16))
        return F.decode(F.unhex(F.lpad(in_hex, 8, "0")), "UTF-32")

    out = F.aggregate(numeric, out, lambda done, ref: F.replace(done, ref, decoded(ref)))
    for name, char in _ENTITIES.items():
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return out


def station_page_url(buoy_id: Column | str) -> Column:
    return F.concat(F.lit(STATION_PAGE_URL), _lit(buoy_id))


# An anchor of this name stands beside the lists of this class, whose items
# read "<id>: <a href=...>yyyy</a> ...".
ARCHIVE_ANCHOR, ARCHIVE_LIST_CLASS = "stdmet", "histfiles"


def list_items(page: Column | str, list_pattern: str) -> Column:
    """Array of ``<li>`` bodies of every list that matches."""
    lists = F.regexp_extract_all(_lit(page), F.lit(list_pattern), F.lit(1))
    return F.flatten(F.transform(lists, lambda body: F.regexp_extract_all(body, F.lit(r"(?s)<li[^>]*>(.*?)</li>"), F.lit(1))))


def item_label(item: Column) -> Column:
    """Text before the first tag of a list item (the station id)."""
    return F.regexp_extract(item, r"(?s)^([^<]*)", 1)


def item_hrefs(item: Column) -> Column:
    quoted = F.regexp_extract_all(item, F.lit(r"""<a[^>]*\shref\s*=\s*("[^"]*"|'[^']*')"""), F.lit(1))
    return F.transform(quoted, lambda q: unescape(F.substring(q, F.lit(2), F.length(q) - 2)))


def _linked(items: DataFrame, keep: list[str], label: Column, hrefs: Column) -> DataFrame:
    """(keep..., url, item_pos, buoy_id, link_pos, href, link, source_stem, year, station_url)."""
    links = items.select(
        *keep,
        "url",
        "item_pos",
        F.when(strip(label) != "", clean_buoy_id(label)).alias("buoy_id"),
        F.posexplode(hrefs).alias("link_pos", "href"),
    )
    out = links.withColumn("link", text_view_link("href"))
    return with_source_identity(out, "link").withColumn("station_url", station_page_url("buoy_id"))


def explode_list_links(pages: DataFrame, list_pattern: str, keep: list[str] | None = None) -> DataFrame:
    """One row per link of every list that matches, anywhere in a page; columns as
    ``explode_archive_index``. A narrow transformation: no shuffle."""
    keep = keep or []
    items = pages.select(*keep, "url", F.posexplode(list_items("html", list_pattern)).alias("item_pos", "item"))
    return _linked(items, keep, unescape(item_label(F.col("item"))), item_hrefs(F.col("item")))


def explode_archive_index(pages: DataFrame, anchor: str = ARCHIVE_ANCHOR, list_class: str = ARCHIVE_LIST_CLASS) -> DataFrame:
    """One row per (station, link) from landed index pages, read by their element tree.

    Output: ``url`` (page), ``item_pos``, ``buoy_id``, ``link_pos``, ``href``, ``link`` (text-view
    form), ``source_stem``, ``year``, ``station_url``. Items without an id keep a
    NULL ``buoy_id`` so the caller can fail loudly, as the reference does.
    A narrow transformation: no shuffle.
    """
    # outer: else the optimiser would read every page two more times, to see whether it holds items
    items = pages.select("url", F.posexplode_outer(html.marked_items(F.col("html"), anchor, list_class)).alias("item_pos", "item")).where("item_pos is not null")
    return _linked(items, [], unescape(F.col("item.label")), F.transform(F.col("item.hrefs"), unescape))
