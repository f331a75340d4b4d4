"""Landed text -> bronze -> clean silver rows, end to end on Spark."""

from __future__ import annotations

import datetime as dt

import pytest

from tests import snippets as S
from tests.conftest import landed, write_text
from tidewater.operators import observations as obs
from tidewater.schema import OBSERVATION_COLUMNS, SENTINELS
from tidewater.sources.bronze import read_observations
from tidewater.sources.station_text import decode_station_text


def decoded(spark, text):
    return decode_station_text(landed(spark, [("7", "2020", "s", text)]))


def typed(spark, text):
    return obs.normalize(decoded(spark, text)).orderBy("line_no").collect()


def test_tree_of_mixed_layouts(spark, root):
    """Every layout of one tree in one read: keys, instants, absent columns."""
    files = {
        ("62107", "2016"): (S.SENTINELS, [(2016, 9, 21, 18, 20), (2016, 9, 21, 18, 50)]),
        ("0078", "2017"): (S.NO_MINUTE, [(2017, 10, 4, 22, 0)]),
        ("62108", "unknown"): (S.TWO_DIGIT, [(1984, 2, 17, 6, 40), (2031, 2, 17, 6, 40)]),
        ("62109", "2008"): (S.FOUR_DIGIT, [(2008, 11, 30, 21, 10)]),
        ("62110", "2007"): (S.LEADING_ZERO, [(2007, 8, 8, 13, 0)]),
        ("62111", "2018"): (S.WITH_PTDY, [(2018, 4, 12, 9, 30)]),
        ("62112", "2019"): (S.MONTH_MINUTE, [(2019, 11, 6, 14, 52)]),
    }
    for (buoy, year), (text, _) in files.items():
        write_text(spark, root, buoy, year, text)
    frame = read_observations(spark, root)
    assert frame.columns == OBSERVATION_COLUMNS
    got = {}
    for r in frame.collect():
        got.setdefault(r["buoy_id"], []).append((r["datetime"], r["pressure_tendency"]))
    assert {b: sorted(t for t, _ in v) for b, v in got.items()} == {b: [dt.datetime(*x) for x in v] for (b, _), (_, v) in files.items()}
    assert got["62111"][0][1] == -1.6 and all(p is None for b, v in got.items() if b != "62111" for _, p in v)
    one = read_observations(spark, root, "2018")
    assert [r["buoy_id"] for r in one.collect()] == ["62111"]
    files = one.inputFiles()  # no other year's folder is opened
    assert files and all("/year=2018/" in f for f in files)


def test_each_column_has_its_own_marker(spark):
    first, second = typed(spark, S.SENTINELS)
    assert (first["wind_direction"], first["wind_speed"], first["gust"]) == (99.0, None, 7.3)
    # a column without a marker of its own keeps the value that marks others
    fields = [n for n in OBSERVATION_COLUMNS[2:] if n != "pressure_tendency"]
    kept = {n: second[n] for n in fields if second[n] is not None}
    assert all(n not in SENTINELS or v not in SENTINELS[n] for n, v in kept.items())
    assert second["wind_direction"] is None and second["pressure"] is None and second["tide"] is None


def test_first_of_equal_instants_stays(spark, root):
    write_text(spark, root, "62113", "2014", S.DUPLICATE)
    (row,) = read_observations(spark, root).collect()
    assert (row["wind_direction"], row["tide"]) == (333.0, 0.6)


def test_lines_that_do_not_fit_the_header(spark):
    text = "#YY MM DD hh mm WDIR WSPD\n2020 01 01 00 00 100\n2020 01 01 01 00 100 5.0 7.7\n"
    short, long = decoded(spark, text).orderBy("line_no").collect()
    assert short["WSPD"] is None and short["decode_error"] is None
    assert long["decode_error"] == "more fields than header"
    assert len(typed(spark, text)) == 1


def test_first_of_a_repeated_header_counts(spark):
    text = "#YY MM DD hh mm WDIR ODD WDIR ODD\n2020 01 01 00 00 100 a 200 b\n"
    (row,) = decoded(spark, text).collect()
    assert (row["WDIR"], row["decode_error"], row["extra"]) == ("100", None, {"ODD": "a"})


@pytest.mark.parametrize("word", ["NA", "NaN", "null", "n/a"])
def test_missing_words_in_date_fields(spark, word):
    minute, spelling = typed(spark, f"#YY MM DD hh mm WDIR\n2020 01 01 00 {word} 7\n"), typed(spark, f"#YY YYYY MM DD hh\n{word} 1999 03 04 05\n")
    assert [r["datetime"] for r in minute] == [dt.datetime(2020, 1, 1)]
    assert [r["datetime"] for r in spelling] == [dt.datetime(1999, 3, 4, 5)]


def test_markers_and_words_in_measurements(spark):
    (row,) = typed(spark, "#YY MM DD hh mm WDIR WSPD GST NEWX\n2020 01 01 00 00 MM NaN Infinity 4.2\n")
    assert (row["wind_direction"], row["wind_speed"], row["gust"]) == (None, None, None)


def test_impossible_dates_are_null_not_errors(spark):
    rows = typed(spark, "#YY MM DD hh mm WDIR\n2020 13 01 00 00 100\n2020 02 30 00 00 100\n2020 01 01 24 00 100\n")
    assert [r["datetime"] for r in rows] == [None, None, None]


def test_tabs_and_crlf_are_whitespace(spark):
    rows = typed(spark, "\t#YY MM DD hh mm WDIR\r\n\t2020\t01 01  00 30\t100\r\n\r\n2020 01 01 01 00 200\r\n")
    assert [(r["datetime"].hour, r["datetime"].minute, r["wind_direction"]) for r in rows] == [(0, 30, 100.0), (1, 0, 200.0)]
