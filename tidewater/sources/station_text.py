"""Decode landed whitespace-delimited station files into bronze rows.

A landed file is one row ``(buoy_id, year, source_stem, value)`` where
``value`` is the whole text: a header line, usually a units line, then data
lines. Decoding is a narrow transformation (no shuffle): split the text into
lines, explode them with their position, split each line on whitespace and
pick every known header name by its position in that file's own header.
Every token stays text; typing is the silver stage's job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import sql
from tidewater.schema import (
    MEASUREMENT_NAMES,
    NA_TOKENS,
    STRUCTURAL_COLUMNS,
)

_KNOWN_HEADERS: list[str] = [*STRUCTURAL_COLUMNS.keys(), *MEASUREMENT_NAMES.keys()]
_BLANK_LINE = r"^\s*$"


_LANDED_STEM = r"([^/]+?)(\.txt)?(\.gz)?$"


def landed_station_files(spark: SparkSession, root: str) -> DataFrame:
    """Landed files laid out as ``<root>/buoy_id=<id>/<stem>.txt[.gz]`` ->
    ``(buoy_id, year, source_stem, value)``: the stem is the file name
    without extensions, the year comes from ``h<yyyy>`` in it (else
    ``unknown``), as for download links."""
    from tidewater.schema import FILENAME_YEAR_PATTERN

    files = spark.read.option("basePath", root).text(root, wholetext=True)
    stem = F.regexp_extract(F.col("_metadata.file_name"), _LANDED_STEM, 1)
    year = F.regexp_extract(F.concat(stem, F.lit(".txt")), FILENAME_YEAR_PATTERN, 1)
    return files.select(
        F.col("buoy_id").cast("string").alias("buoy_id"),
        F.when(year != "", year).otherwise(F.lit("unknown")).alias("year"),
        stem.alias("source_stem"),
        "value",
    )


def _strip(line: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` only strips
    spaces; a tab-indented line would otherwise gain an empty first token)."""
    return F.regexp_replace(line, r"^\s+|\s+$", "")


def decode_station_text(
    text: DataFrame, keep: list[str] | None = None, keep_header: bool = False
) -> DataFrame:
    """Mechanical decode of landed station text into bronze-shaped rows.

    Input columns: ``buoy_id``, ``year``, ``source_stem``, ``value`` (plus any
    listed in ``keep``). Output: one row per line after the header with
    ``line_no`` (header is line 0), one text column per known header name, an
    ``extra`` map for other header names and ``decode_error`` (NULL when the
    line is fine). A line longer than its header is flagged instead of
    shifted; of a repeated header name the first column counts. Missing-value
    words are NULL in the date and time fields. A header-only file yields no
    rows (one row, the header itself, with ``keep_header``); an empty file
    yields none.
    """
    keep = keep or []
    # Per file (not per line): split into non-blank lines, parse the header,
    # and derive everything that depends on the header alone.
    lines = F.filter(F.split(F.col("value"), r"\r?\n"), lambda l: ~l.rlike(_BLANK_LINE))
    with_lines = text.select("buoy_id", "year", "source_stem", *keep, lines.alias("lines"))
    header = F.split(_strip(F.get(F.col("lines"), 0)), r"\s+")
    with_header = with_lines.select("*", header.alias("header"))
    files = with_header.select(
        "buoy_id",
        "year",
        "source_stem",
        *keep,
        "lines",
        "header",
        F.size("header").alias("n_header"),
        F.array_distinct(F.filter("header", lambda h: ~h.isin(*_KNOWN_HEADERS))).alias("unknown"),
        # Position of every known header name in this file (-1 when absent),
        # computed once per file rather than once per line.
        F.expr(
            "named_struct("
            + ", ".join(f"'i{k}', CAST(array_position(header, '{h}') AS INT) - 1" for k, h in enumerate(_KNOWN_HEADERS))
            + ")"
        ).alias("idx"),
    )
    exploded = files.select(
        "buoy_id",
        "year",
        "source_stem",
        *keep,
        "header",
        "n_header",
        "unknown",
        "idx",
        F.posexplode("lines").alias("pos", "line"),
    )
    if not keep_header:
        exploded = exploded.where(F.col("pos") > 0)
    rows = exploded.select(
        "buoy_id",
        "year",
        "source_stem",
        *keep,
        "header",
        "n_header",
        "unknown",
        "idx",
        F.col("pos").cast("int").alias("line_no"),
        F.split(_strip(F.col("line")), r"\s+").alias("tokens"),
    )
    na_words = ", ".join(sql.literal(w) for w in NA_TOKENS)
    token_of = "get(tokens, CAST(array_position(header, h) AS INT) - 1)"
    extra = (
        "CASE WHEN size(unknown) > 0 THEN map_from_entries(transform(unknown, h -> "
        f"named_struct('key', h, 'value', CASE WHEN NOT ({token_of} IN ({na_words})) THEN {token_of} END))) END"
    )
    error = "CASE WHEN size(tokens) > n_header THEN 'more fields than header' END"
    # The date and time fields are coalesced later (spellings of the year, an
    # absent minute), so their missing-value words become NULL here; the typed
    # stage turns every other non-numeric token into NULL.
    token = {raw: f"get(tokens, idx.i{k})" for k, raw in enumerate(_KNOWN_HEADERS)}
    fields = [
        f"CASE WHEN NOT ({token[raw]} IN ({na_words})) THEN {token[raw]} END AS {sql.ident(col)}"
        for raw, col in STRUCTURAL_COLUMNS.items()
    ] + [f"{token[m]} AS {sql.ident(m)}" for m in MEASUREMENT_NAMES]
    return rows.selectExpr(
        "source_stem",
        "line_no",
        *fields,
        f"{extra} AS extra",
        f"{error} AS decode_error",
        "buoy_id",
        "year",
        *[sql.ident(k) for k in keep],
    )

