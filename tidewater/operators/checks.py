"""Integrity checks the serving table would enforce as constraints.

Spark enforces none of them, so each is a query whose result must be zero.
All checks are computed as aggregates; the uniqueness check is a grouped
count (partial map-side) followed by a global count of offending keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.admission import year_bounds
from tidewater.schema import RUN_STATUSES


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (must be empty)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def outside_year(ts: Column, year: Column) -> Column:
    low, high = year_bounds(year)
    return (ts < low) | (ts >= high)


def status_outside_domain(status: Column) -> Column:
    return status.isNull() | ~status.isin(*RUN_STATUSES)


def _named(check: str, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(check).alias("check"), "violations")


def unique_check(df: DataFrame, keys: list[str]) -> DataFrame:
    return _named("unique_key", duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations")))


def not_null_check(df: DataFrame, cols: list[str]) -> DataFrame:
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    return _named("not_null", df.agg(F.count_if(missing).alias("violations")))


def year_range_check(df: DataFrame, ts: Column, year: Column) -> DataFrame:
    return _named("in_year_range", df.agg(F.count_if(outside_year(ts, year)).alias("violations")))


def status_check(df: DataFrame, status: Column) -> DataFrame:
    return _named("status_domain", df.agg(F.count_if(status_outside_domain(status)).alias("violations")))


def integrity_report(
    df: DataFrame, keys: list[str], not_null: list[str], ts_col: str, year_col: str
) -> DataFrame:
    """``(check, violations)`` rows for uniqueness, not-null and range."""
    report = unique_check(df, keys).unionByName(not_null_check(df, not_null))
    return report.unionByName(year_range_check(df, F.col(ts_col), F.col(year_col)))


def assert_clean(report: DataFrame) -> None:
    """Raise if any check has violations (one small collect of ≤4 rows)."""
    assert_none({r["check"]: r["violations"] for r in report.collect()})


def assert_none(violations: dict[str, int]) -> None:
    """Raise if any named check has violations."""
    bad = {name: n for name, n in violations.items() if n}
    if bad:
        raise ValueError(f"integrity checks failed: {sorted(bad.items())}")
