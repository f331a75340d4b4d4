"""Bronze observation rows -> typed, cleaned, de-duplicated silver rows.

All steps are column expressions over one scan (no UDF): units-row drop,
year spelling coalesce, two-digit year pivot, timestamp construction, safe
numeric cast, per-column sentinel nulling. The only shuffle is the
keep-first dedup on (load year, buoy, instant).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.sql import ident
from tidewater.functions.sql import literal as _sql_literal
from tidewater.schema import (
    MEASUREMENT_NAMES,
    OBSERVATION_COLUMNS,
    SENTINELS,
    STRUCTURAL_COLUMNS,
    YEAR_HEADERS,
    YEAR_PIVOT,
)

_YEAR_TEXT = r"^[0-9]{2,4}$"


# Each rule is written once, as SQL text over a column reference; the
# column functions below wrap it for DataFrame code, ``normalize`` inlines it
# into its staged projections.


def _year_raw_sql(df_cols: list[str] | None = None) -> str:
    names = [STRUCTURAL_COLUMNS[h] for h in YEAR_HEADERS]
    if df_cols is not None:
        names = [n for n in names if n in df_cols]
    if not names:
        return "CAST(NULL AS STRING)"
    refs = [ident(n) for n in names]
    return f"coalesce({', '.join(refs)})" if len(refs) > 1 else refs[0]


def _is_data_row_sql(c: str) -> str:
    return f"{c} RLIKE {_sql_literal(_YEAR_TEXT)}"


def _four_digit_year_sql(c: str) -> str:
    return (
        f"CASE WHEN length({c}) = 2 THEN CASE WHEN try_cast({c} AS INT) < {YEAR_PIVOT} "
        f"THEN concat('20', {c}) ELSE concat('19', {c}) END ELSE {c} END"
    )


def _safe_int_sql(c: str) -> str:
    # ``try_cast`` to INT already yields NULL for every non-integer form
    # (``10.0``, ``1e3``, ``0x10``, words, overflow): no regex needed.
    return f"try_cast({c} AS INT)"


def _safe_double_sql(c: str) -> str:
    # ``try_cast`` alone would also accept ``1d``, ``1f``, ``Infinity``,
    # ``NaN`` and hex floats. Allowing only digits, ``.``, ``e``/``E`` and
    # signs rules all of those out; ``try_cast`` rejects the remaining
    # malformed strings (``1.5e``, ``--1``, ``.``). A character map, not a
    # regex, per value.
    return f"CASE WHEN translate({c}, '0123456789.eE+-', '') = '' THEN try_cast({c} AS DOUBLE) END"


def _sentinel_sql(c: str, semantic_name: str) -> str:
    sentinels = SENTINELS.get(semantic_name, ())
    if not sentinels:
        return c
    values = ", ".join(repr(float(v)) for v in sentinels)
    return f"CASE WHEN NOT ({c} IN ({values})) THEN {c} END"


def year_raw(df_cols: list[str] | None = None) -> Column:
    """First present spelling of the year field (``#YY``, ``YYYY``, ``YY``)."""
    return F.expr(_year_raw_sql(df_cols))


def is_data_row(year_col: str) -> Column:
    """Units rows (``#yr``, ``yr``) fail this; data rows carry 2-4 digits."""
    return F.expr(_is_data_row_sql(ident(year_col)))


def four_digit_year(year_col: str) -> Column:
    """Two characters pivot at 50 (<50 -> 20xx, else 19xx); other lengths pass."""
    return F.expr(_four_digit_year_sql(ident(year_col)))


def safe_int(text_col: str) -> Column:
    """Integer text -> INT; anything else (``XX``, ``10.0``) -> NULL."""
    return F.expr(_safe_int_sql(ident(text_col)))


def safe_double(text_col: str) -> Column:
    """Numeric text -> DOUBLE; markers such as ``MM``, ``nan``, ``1d`` -> NULL."""
    return F.expr(_safe_double_sql(ident(text_col)))


def nullify_sentinel(value_col: str, semantic_name: str) -> Column:
    """NULL where the column's own sentinel matches; other values kept."""
    return F.expr(_sentinel_sql(ident(value_col), semantic_name))


def build_timestamp(year_col: str, month_col: str, day_col: str, hour_col: str, minute_col: str) -> Column:
    """Zone-less timestamp from integer text parts; NULL when any part is
    missing, not an integer, or out of range (month 13, Feb 30, hour 24)."""
    parts = ", ".join(_safe_int_sql(ident(c)) for c in (year_col, month_col, day_col, hour_col, minute_col))
    return F.expr(f"try_make_timestamp_ntz({parts}, 0)")


def normalize(bronze: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed rows from bronze-shaped rows (one per decoded line).

    Output: ``buoy_id``, ``datetime``, the 14 measurements, plus lineage
    columns ``load_year`` (hive year text), ``source_stem`` and ``line_no``
    used by the dedup order, plus any ``keep`` columns. Rows flagged by the
    decoder are dropped here; count them from bronze.

    Written as a short chain of projections in which every parsed value is
    referenced once per step: Catalyst keeps a non-trivial expression in its
    own projection when the next one uses it twice, so each regex / cast
    runs once per row and the generated code stays small enough to JIT.
    The steps are SQL expressions (one parse each on the JVM side).
    """
    keep = keep or []
    cols = bronze.columns
    src = bronze
    if "decode_error" in cols:
        src = src.where(F.col("decode_error").isNull())

    def raw(name: str) -> str:
        return f"`{name}`" if name in cols else "CAST(NULL AS STRING)"

    year_sql = _year_raw_sql(cols)
    minute_sql = "coalesce(`minute_raw`, '0')" if "minute_raw" in cols else "'0'"
    keep_sql = [f"`{k}`" for k in keep]
    lineage = ["`load_year`", "`source_stem`", "`line_no`", *keep_sql]
    codes = list(MEASUREMENT_NAMES)
    step1 = src.selectExpr(
        "CAST(buoy_id AS STRING) AS buoy_id",
        f"{year_sql} AS _year",
        f"{raw('month_raw')} AS _month",
        f"{raw('day_raw')} AS _day",
        f"{raw('hour_raw')} AS _hour",
        f"{minute_sql} AS _minute",
        *[f"{raw(code)} AS `_{code}`" for code in codes],
        "`year` AS load_year",
        "`source_stem`",
        "`line_no`",
        *keep_sql,
    ).where(_is_data_row_sql("_year"))
    step2 = step1.selectExpr(
        "buoy_id",
        f"{_four_digit_year_sql('_year')} AS _year4",
        *[f"{_safe_int_sql(c)} AS {c}" for c in ("_month", "_day", "_hour", "_minute")],
        *[f"{_safe_double_sql(f'`_{code}`')} AS `_{code}`" for code in codes],
        *lineage,
    )
    step3 = step2.selectExpr(
        "buoy_id",
        f"{_safe_int_sql('_year4')} AS _y",
        "_month", "_day", "_hour", "_minute",
        *[f"{_sentinel_sql(f'`_{code}`', name)} AS {name}" for code, name in MEASUREMENT_NAMES.items()],
        *lineage,
    )
    return step3.selectExpr(
        "buoy_id",
        "try_make_timestamp_ntz(_y, _month, _day, _hour, _minute, 0) AS datetime",
        *MEASUREMENT_NAMES.values(),
        *lineage,
    )


def dedup_keep_first(typed: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """One row per (scope..., buoy_id, datetime): the first by source order.

    ``row_number() = 1`` is planned as a partial WindowGroupLimit before the
    shuffle and a final one after, so even a key holding a large share of
    all copies is cut down map-side before it is exchanged. NULL datetimes of
    one buoy form one group, as in the reference semantics.
    """
    keys = [*(scope or []), "buoy_id", "datetime"]
    w = Window.partitionBy(*keys).orderBy("source_stem", "line_no")
    return (
        typed.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def to_contract(df: DataFrame) -> DataFrame:
    """Exact silver column order."""
    return df.select(*OBSERVATION_COLUMNS)


def clean_observations(bronze: DataFrame, per_load_year: bool = False) -> DataFrame:
    """Full silver transform: normalize -> dedup -> contract columns.

    ``per_load_year=True`` dedups within each hive year (a year-scoped load);
    False dedups over the whole read, as a whole-tree read does.
    """
    typed = normalize(bronze)
    deduped = dedup_keep_first(typed, ["load_year"] if per_load_year else None)
    return to_contract(deduped)
