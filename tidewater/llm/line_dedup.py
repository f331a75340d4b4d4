"""Cross-site boilerplate lines, by the spread of a line over distinct sites.

A line's sites are sketched (HyperLogLog) per line hash; sketches of the tasks
merge in the aggregation. Lines whose estimate is clearly below ``SITES`` stay,
those clearly above go, and only lines within ``MARGIN`` standard errors of it
get an exact distinct count. Documents then lose their boilerplate lines.

A line is what stands between line feeds, without the spaces around it; blank
lines are never boilerplate. Defined results: null text is the empty text (one
blank line); a null site is none; repeated rows and null ids keep a row each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SITES = 6
#: 2 ** PRECISION registers: a standard error of 1.04 / sqrt of that.
PRECISION = 10
MARGIN = 4
#: Bytes of (document, line numbers) that are sent to every task; beyond, a shuffled join.
BROADCAST_BYTES = 64 << 20


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, site, line_no, line): the hash of each line that isn't blank."""
    rows = docs.select("doc_id", "text_key", "site", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.select("doc_id", "text_key", "site", "line_no", F.trim("line").alias("line")).where("line != ''").withColumn("line", F.xxhash64("line"))


def _documents(docs: DataFrame, site: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.col(site).cast("string").alias("site"))
    return rows.withColumn("text_key", F.xxhash64("text"))


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """(line) hashes of the lines seen on at least ``sites`` sites."""
    error = MARGIN * 1.04 / 2 ** (PRECISION / 2)
    spread = lines.where("site is not null").groupBy("line").agg(F.hll_sketch_agg(F.xxhash64("site"), F.lit(PRECISION)).alias("sketch"))
    spread = spread.select("line", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= sites * (1 - error) - 1)
    spread = written(spread, "line-spread")
    sure = F.col("estimate") > sites * (1 + error) + 1
    near = lines.where("site is not null").join(spread.where(~sure).select("line"), "line", "left_semi")
    exact = near.groupBy("line").agg(F.count_distinct("site").alias("n")).where(F.col("n") >= sites)
    return spread.where(sure).select("line").unionByName(exact.select("line"))


def remove_boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES, with_text: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256[, kept]) of every row of ``docs``."""
    rows = _documents(docs, site)
    lines = _lines(rows)
    bad = lines.join(boilerplate(lines, sites), "line").groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))
    bad = written(bad.select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key"), "removed"), "boilerplate-lines")
    size = bad.agg(F.sum(F.size("removed") * 4 + 48)).first()[0] or 0
    joined = rows.join(
        F.broadcast(bad) if size <= BROADCAST_BYTES else bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("text_key") == F.col("bad_key")), "left"
    )
    all_lines = F.split("text", "\n")
    kept = F.when(F.col("removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(all_lines, lambda line, no: ~F.array_contains("removed", no)), "\n")
    )
    out = joined.select("doc_id", F.size(all_lines).cast("bigint").alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"), kept.alias("kept"))
    out = out.withColumn("n_removed", F.greatest("n_removed", F.lit(0).cast("bigint"))).withColumn("kept_sha256", F.sha2("kept", 256))
    return out if with_text else out.drop("kept")


ORACLE_SQL = f"""
WITH parts AS (
  SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM parts
), boilerplate AS (
  SELECT trim(line) AS bad FROM lines WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {SITES}
)
SELECT doc_id, count(*) AS n_lines, count(bad) AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN bad IS NULL THEN line END, chr(10) ORDER BY line_no), '')) AS kept_sha256
FROM lines LEFT JOIN boilerplate ON trim(line) = bad
GROUP BY doc_id
"""
