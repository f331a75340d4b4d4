"""Station position from text and from landed station pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import sql
from tidewater.schema import COORDINATE_PATTERN, POSITION_ITEM_ORDER


_PAIR = sql.literal(COORDINATE_PATTERN)

# Each rule is written once, as SQL text; the column functions wrap it and
# ``positions_from_pages`` inlines it into staged projections.


def _matches_sql(text: str) -> str:
    """All ``<decimal> <hemisphere>`` pairs, as full matches."""
    return f"regexp_extract_all(coalesce({text}, ''), {_PAIR}, 0)"


def _valid_sql(text: str) -> str:
    return f"({text} IS NOT NULL AND size({_matches_sql(text)}) >= 2)"


def _signed_sql(matches: str, i: int, negative: str) -> str:
    number = f"CAST(regexp_extract({matches}[{i}], {_PAIR}, 1) AS DOUBLE)"
    return (
        f"CASE WHEN size({matches}) >= 2 THEN CASE WHEN regexp_extract({matches}[{i}], {_PAIR}, 2) = "
        f"'{negative}' THEN -{number} ELSE {number} END END"
    )


def is_valid_coordinates(text_col: str) -> Column:
    """Not NULL and at least two pairs; integers such as ``48 N`` do not count."""
    return F.expr(_valid_sql(sql.ident(text_col)))


def parse_coordinates(text_col: str) -> Column:
    """Struct ``(latitude, longitude)`` from the first two pairs.

    The first pair is the latitude whatever its letter (negative only for
    S), the second the longitude (negative only for W). Fewer than two pairs
    -> both NULL; the caller records the status.
    """
    m = _matches_sql(sql.ident(text_col))
    return F.expr(
        f"named_struct('latitude', {_signed_sql(m, 0, 'S')}, 'longitude', {_signed_sql(m, 1, 'W')})"
    )


# The first <p> of the station metadata block, and its bold items. An item's
# text is what precedes its first child tag.
_METADATA_PARAGRAPH = r"""(?s)<div[^>]*\sid\s*=\s*["']stn_metadata["'][^>]*>.*?<p(?:\s[^>]*)?>(.*?)</p>"""
_BOLD_TEXT = r"(?s)<b(?:\s[^>]*)?>([^<]*)"


def positions_from_pages(pages: DataFrame, buoy_col: str = "buoy_id") -> DataFrame:
    """``(buoy_id, latitude, longitude, status)`` per landed station page.

    Tries bold items 4, 3, 2, 5 of the first metadata paragraph and takes
    the first valid one. Otherwise the status depends on item 5: present
    with text -> ``unparseable``, empty or absent -> ``missing``; the pair is
    NULL either way. Written as staged SQL projections: the bold items are
    extracted once per page, each candidate is tested once.
    """
    items = pages.selectExpr(
        f"{sql.ident(buoy_col)} AS buoy_id",
        f"regexp_extract_all(regexp_extract(html, {sql.literal(_METADATA_PARAGRAPH)}, 1), "
        f"{sql.literal(_BOLD_TEXT)}, 1) AS _items",
    )
    order = list(POSITION_ITEM_ORDER)
    cands = items.selectExpr("buoy_id", *[f"get(_items, {k - 1}) AS _c{k}" for k in order])
    valid = cands.selectExpr(
        "buoy_id",
        *[f"_c{k}" for k in order],
        *[f"{_valid_sql(f'_c{k}')} AS _v{k}" for k in order],
    )
    last = order[-1]
    chosen = valid.selectExpr(
        "buoy_id",
        "CASE " + " ".join(f"WHEN _v{k} THEN _c{k}" for k in order) + " END AS _chosen",
        f"_c{last} IS NOT NULL AND _c{last} <> '' AS _has_last",
    )
    matches = chosen.selectExpr(
        "buoy_id",
        f"{_matches_sql('_chosen')} AS _m",
        "CASE WHEN _chosen IS NOT NULL THEN 'ok' WHEN _has_last THEN 'unparseable' ELSE 'missing' END AS status",
    )

    return matches.selectExpr(
        "buoy_id", f"{_signed_sql('_m', 0, 'S')} AS latitude", f"{_signed_sql('_m', 1, 'W')} AS longitude", "status"
    )
