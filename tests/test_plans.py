"""Plan shapes the scale design relies on (checked on small inputs)."""

from __future__ import annotations

from tests import snippets as S
from tests.conftest import landed, write_text
from tidewater.plans.queries import QUERIES
from tidewater.sinks.bronze import write_bronze_observations
from tidewater.sources.bronze import read_bronze_observations

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_cuts_copies_before_the_shuffle(spark):
    plan = _plan(QUERIES["dedup_keep_first"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    # The partial limit sits below the exchange, the final one above it.
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(buoy_id") < plan.rindex("Partial")


def test_bronze_reads_leave_the_rows_where_they_are(spark, root):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # everything is above it
    try:
        # two sources in one folder, one of them fetched again: only then rows pass a join
        write_bronze_observations(landed(spark, [("62107", "2016", "a", S.SENTINELS), ("62107", "2016", "b", S.NO_MINUTE)]), root)
        assert "Join" not in _plan(read_bronze_observations(spark, root))  # nothing superseded: a scan
        write_text(spark, root, "62107", "2016", S.NO_MINUTE, stem="a")
        frame = read_bronze_observations(spark, root)
        assert frame.count() == 6
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert "LeftAnti" in plan
    assert not any("Exchange hashpartitioning" in line and "WDIR" in line for line in plan.splitlines())


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["freshness"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_bronze_write_has_no_exchange(spark):
    from tests.conftest import landed
    from tidewater.sources.station_text import decode_station_text

    decoded = decode_station_text(landed(spark, [("62107", "2016", "a", S.SENTINELS)]), keep_header=True)
    assert "Exchange" not in _plan(decoded.sortWithinPartitions("year", "buoy_id"))
