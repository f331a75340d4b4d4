"""Bronze writer and current-version reads."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests import snippets as S
from tests.conftest import landed, write_text
from tidewater.sinks.bronze import Counted, ingest_batch_id, write_bronze_observations
from tidewater.sources import bronze
from tidewater.sources.bronze import read_bronze_observations, read_observations


def test_normal_file_keeps_text_tokens(spark, root):
    counters = write_text(spark, root, "62107", "2005", S.SHORT_ONE_ROW, stem="62107h2005")
    assert counters["rows_written"] == 2 and counters["lines_flagged"] == 0
    data = read_bronze_observations(spark, root).orderBy("line_no").collect()[1]
    assert [data[c] for c in ("yy_hash", "month_raw", "day_raw", "hour_raw", "minute_raw", "WDIR", "WSPD", "PRES")] == "2005 07 19 16 40 265 3.4 1019.8".split()
    assert (data["buoy_id"], data["year"], data["source_stem"]) == ("62107", "2005", "62107h2005")


def test_header_only_file_is_readable_and_empty_in_silver(spark, root):
    write_text(spark, root, "62121", "2012", S.HEADER_ONLY)
    (header,) = read_bronze_observations(spark, root).collect()
    assert (header["line_no"], header["yy_hash"]) == (0, "#YY")
    assert read_observations(spark, root).count() == 0


def test_schema_less_file_writes_nothing_and_is_counted(spark, root):
    counters = write_bronze_observations(landed(spark, [("62121", "2012", "s", "")]), root)
    assert (counters["files_seen"], counters["bronze_skipped_no_schema"], counters["rows_written"]) == (1, 1, 0)
    assert read_bronze_observations(spark, root).count() == 0
    assert not os.path.exists(os.path.join(root, "manifests"))


def test_refetched_file_replaces_only_itself(spark, root):
    for stem, text in (("a", S.SENTINELS), ("b", S.NO_MINUTE), ("a", S.MONTH_MINUTE)):
        write_text(spark, root, "62107", "2016", text, stem=stem)
    assert {r["source_stem"] for r in read_bronze_observations(spark, root).collect()} == {"a", "b"}
    assert sorted(r["datetime"] for r in read_observations(spark, root).collect()) == [dt.datetime(2017, 10, 4, 22), dt.datetime(2019, 11, 6, 14, 52)]


def test_batch_without_manifest_is_not_committed(spark, root):
    write_text(spark, root, "62107", "2016", S.SENTINELS, stem="a")
    write_text(spark, root, "62107", "2016", S.NO_MINUTE, stem="a")
    newest = sorted(os.listdir(os.path.join(root, "manifests")))[-1]
    os.rename(os.path.join(root, "manifests", newest), os.path.join(root, "crashed"))
    assert read_observations(spark, root).count() == 2


def test_batches_sort_after_those_held(spark, root):
    os.makedirs(os.path.join(root, "batch=99990101000000000000-aaaaaa"))
    assert ingest_batch_id(spark, root) > "99990101000000000000-aaaaaa"


def test_lost_counters_are_counted_again(spark):
    counted = Counted(spark.range(7), rows=F.count(F.lit(1)))

    class Lost:
        @property
        def get(self):
            raise RuntimeError("no metrics")

    counted.observation = Lost()
    assert counted.get() == {"rows": 7}


def test_flagged_lines_of_current_versions(spark, root):
    long = S.NO_MINUTE + "2017 10 04 23 " + "1 " * 40 + "\n"
    write_text(spark, root, "62107", "2017", long, stem="a")
    write_text(spark, root, "62108", "2017", long, stem="b")
    write_text(spark, root, "62108", "2017", S.NO_MINUTE, stem="b")
    assert bronze.flagged_lines(spark, root, ["2017"]) == {"2017": 1}


@pytest.mark.parametrize("limit", [bronze.BROADCAST_VERSIONS, 0])
def test_both_ways_to_drop_superseded_versions(spark, root, monkeypatch, limit):
    monkeypatch.setattr(bronze, "BROADCAST_VERSIONS", limit)
    write_text(spark, root, "62107", "2016", S.SENTINELS, stem="a")
    write_text(spark, root, "62107", "2016", S.NO_MINUTE, stem="a")
    assert [r["datetime"] for r in read_observations(spark, root).collect()] == [dt.datetime(2017, 10, 4, 22)]
