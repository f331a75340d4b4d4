"""Ingest plans: landed responses -> bronze, archive index -> fetch plan."""

from __future__ import annotations

import pytest

from tests import snippets as S
from tidewater.plans.ingest import archive_links, ingest_station_text, landed_text_frame, plan_fetch
from tidewater.sources.bronze import read_observations

BASE = "/historical_data/view_text_file.php?dir=data/historical/stdmet/&filename="


def _index(spark, items):
    lis = "".join(
        f'<li>{buoy}: ' + " ".join(f'<a href="/download_data.php?filename={buoy}h{y}.txt.gz&dir=x/">{y}</a>' for y in years) + "</li>"
        for buoy, years in items
    )
    html = f'<div><a id="stdmet">Standard meteorological</a><ul class="histfiles">{lis}</ul></div>'
    return spark.createDataFrame([("https://example.org/historical", html)], "url string, html string")


def test_ingest_then_plan_skips_closed_years(spark, root):
    responses = spark.createDataFrame(
        [
            ("41001", BASE + "41001h2019.txt.gz", S.SENTINELS.replace("2016", "2019")),
            ("41001", BASE + "41001h2019.txt.gz", S.SENTINELS.replace("2016", "2019")),
            ("41002", BASE + "41002h2019.txt.gz", S.HEADER_ONLY),
            ("41003", BASE + "41003h2019.txt.gz", "   \n"),
        ],
        "buoy_id string, url string, value string",
    )
    counters = ingest_station_text(spark, responses, root)
    assert counters["bronze_skipped_no_schema"] == 1
    assert counters["files_seen"] == 3
    assert len(read_observations(spark, root).collect()) == 2

    index = _index(spark, [("41001", [2019, 2024]), ("41002", [2019]), ("41003", [2019])])
    plan = plan_fetch(spark, index, root, as_of_year=2024)
    fetch = sorted((r["buoy_id"], r["year"]) for r in plan.where("kind = 'observations'").collect())
    pages = sorted(r["url"].split("=")[1] for r in plan.where("kind = 'station_page'").collect())
    assert pages == ["41001", "41002", "41003"]
    # 41001/2019 and the header-only 41002/2019 are closed and readable; the
    # schema-less 41003 file was never written, the current year is always fetched.
    assert fetch == [("41001", "2024"), ("41003", "2019")]
    full = plan_fetch(spark, index, root, as_of_year=2024, full_refresh=True).where("kind = 'observations'").count()
    assert full == 4


def test_empty_index_is_an_error(spark):
    page = spark.createDataFrame([("u", "<html>moved</html>")], "url string, html string")
    with pytest.raises(ValueError):
        archive_links(page)


def test_one_response_per_url_without_moving_the_others(spark):
    rows = [("1", BASE + "1h2001.txt.gz", "b"), ("1", BASE + "1h2001.txt.gz", "a"), ("1", BASE + "1h2001.txt.gz", "a"), ("2", BASE + "2h2001.txt.gz", "c"), ("3", BASE + "3h2001.txt.gz", None)]
    kept = [sorted((r["buoy_id"], r["value"] or "") for r in landed_text_frame(spark.createDataFrame(order, "buoy_id string, url string, value string")).collect()) for order in (rows, rows[::-1])]
    assert kept[0] == kept[1] and [b for b, _ in kept[0]] == ["1", "2", "3"]


def test_landed_files_layout(spark, tmp_path):
    import gzip
    import os

    from tidewater.sources.station_text import landed_station_files

    land = tmp_path / "landed"
    (land / "buoy_id=41001").mkdir(parents=True)
    (land / "buoy_id=41001" / "41001h2020.txt").write_text(S.SENTINELS.strip() + "\n")
    (land / "buoy_id=0042").mkdir(parents=True)
    with gzip.open(os.path.join(land, "buoy_id=0042", "0042h2021.txt.gz"), "wt") as fh:
        fh.write(S.WITH_PTDY.strip() + "\n")
    (land / "buoy_id=0042" / "notes.txt").write_text(S.NO_MINUTE.strip() + "\n")
    files = {r["source_stem"]: (r["buoy_id"], r["year"]) for r in landed_station_files(spark, str(land)).collect()}
    assert files == {"41001h2020": ("41001", "2020"), "0042h2021": ("0042", "2021"), "notes": ("0042", "unknown")}


def test_rescraped_station_replaces_position(spark, root):
    from tidewater.plans.ingest import ingest_station_pages
    from tidewater.sinks.bronze import write_bronze_coordinates
    from tidewater.sources.bronze import read_coordinates

    def page(pos):
        return f'<div id="stn_metadata"><p><b>a</b><b>b</b><b>c</b><b>{pos}</b></p></div>'

    first = spark.createDataFrame([("41001", page("1.000 N 2.000 E")), ("41002", page("3.000 S 4.000 W"))], "buoy_id string, html string")
    ingest_station_pages(spark, first, root)
    second = spark.createDataFrame([("41001", page("no position"))], "buoy_id string, html string")
    ingest_station_pages(spark, second, root)
    got = {r["buoy_id"]: (r["latitude"], r["longitude"]) for r in read_coordinates(spark, root).collect()}
    assert got == {"41001": (None, None), "41002": (-3.0, -4.0)}
    empty = write_bronze_coordinates(spark.createDataFrame([], "buoy_id string, latitude double, longitude double, status string"), root)
    assert empty["stations"] == 0
