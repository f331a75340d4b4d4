"""Coordinate parsing, station-page positions, archive index explode."""

from __future__ import annotations

import pytest

from tidewater.functions import coordinates as C
from tidewater.functions import links


def _parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [
        (r["p"]["latitude"], r["p"]["longitude"], r["v"])
        for r in df.select(C.parse_coordinates("t").alias("p"), C.is_valid_coordinates("t").alias("v")).collect()
    ]


@pytest.mark.parametrize(
    "text,lat,lon",
    [
        ("51.104 N 2.737 W (51\u00b06'14\" N 2\u00b044'13\" W)", 51.104, -2.737),
        ("8.020 S 117.455 E", -8.020, 117.455),
        ("64.001 N 21.990 W", 64.001, -21.990),
        ("0.500 S 0.250 W", -0.5, -0.25),
        ("1.000 N 2.000 E 3.000 S", 1.0, 2.0),
        ("7.5S 9.75E", -7.5, 9.75),
    ],
)
def test_parse(spark, text, lat, lon):
    got = _parse(spark, [text])[0]
    assert got[0] == pytest.approx(lat) and got[1] == pytest.approx(lon) and got[2] is True


@pytest.mark.parametrize("text", [None, "", "51.104 N", "moored off the cape", "51 N 2 W"])
def test_invalid(spark, text):
    lat, lon, valid = _parse(spark, [text])[0]
    assert lat is None and lon is None and valid is False


def _page(items, extra=""):
    body = "".join(f"<b>{i}</b><br>" for i in items)
    return f'<html><div id="stn_metadata"><p>{body}</p>{extra}</div></html>'


@pytest.mark.parametrize(
    "items,expected",
    [
        (["a", "b", "c", "1.500 N 2.500 W", "9.000 S 9.000 E"], (1.5, -2.5, "ok")),
        (["a", "b", "3.000 S 4.000 E", "x", "9.000 S 9.000 E"], (-3.0, 4.0, "ok")),
        (["a", "5.000 N 6.000 E", "c", "d"], (5.0, 6.0, "ok")),
        (["a", "b", "c", "d", "7.000 N 8.000 W"], (7.0, -8.0, "ok")),
        (["a", "b", "c", "d", "51 N 2 W"], (None, None, "unparseable")),
        (["a", "b", "c", "d", ""], (None, None, "missing")),
        (["a", "b"], (None, None, "missing")),
    ],
)
def test_position_from_page(spark, items, expected):
    html = _page(items, extra="<p><b>1.000 N 1.000 E</b></p>")
    df = spark.createDataFrame([("1", html)], "buoy_id string, html string")
    r = C.positions_from_pages(df).collect()[0]
    assert (r["latitude"], r["longitude"], r["status"]) == expected


def _index(body):
    return f'<h2>x</h2><div><a id="stdmet">Standard</a>{body}</div><div><a id="other"></a><ul class="histfiles"><li>9: <a href="/n">n</a></li></ul></div>'


def exploded(spark, html):
    frame = links.explode_archive_index(spark.createDataFrame([("index", html)], "url string, html string"))
    return frame.orderBy("item_pos", "link_pos").collect()


def link(buoy, year, sep="&"):
    return f"/download_data.php?dir=d/{sep}filename={buoy}h{year}.txt.gz"


def test_all_lists_of_the_section(spark):
    lists = [f'<ul class="histfiles"><li> 62107: <a href="{link(62107, 1991)}">1991</a> <a href="{link(62107, 1992)}">1992</a></li></ul>',
             f"<p>more</p><ul class='histfiles'><li>62108:<a href='{link(62108, 1990)}'>1990</a></li></ul>"]
    rows = exploded(spark, _index("".join(lists)))
    assert [(r["buoy_id"], r["year"], r["source_stem"]) for r in rows] == [
        ("62107", "1991", "62107h1991"), ("62107", "1992", "62107h1992"), ("62108", "1990", "62108h1990")
    ]
    assert rows[0]["link"] == link(62107, 1991).replace("download_data", "view_text_file")
    assert rows[0]["station_url"].endswith("station=62107")


@pytest.mark.parametrize("space", ["\n  ", "\t", "\r\n", "\u00a0 "])
def test_white_space_around_ids(spark, space):
    (row,) = exploded(spark, _index(f'<ul class="histfiles"><li>{space}62107:{space}<a href="{link(62107, 1991)}">1</a></li></ul>'))
    assert row["buoy_id"].strip("\u00a0 ") == "62107" and "\n" not in row["buoy_id"] and "\t" not in row["buoy_id"]


@pytest.mark.parametrize("sep", ["&amp;", "&#38;", "&#x26;"])
def test_escaped_links(spark, sep):
    (row,) = exploded(spark, _index(f'<ul class="histfiles"><li>62107: <a href="{link(62107, 1991, sep)}">1</a></li></ul>'))
    assert (row["year"], row["link"]) == ("1991", link(62107, 1991).replace("download_data", "view_text_file"))


def test_unescape(spark):
    texts = {"a &lt;b&gt; &quot;c&quot; &apos;": "a <b> \"c\" '", "&amp;lt; &amp;#38;": "&lt; &#38;", "&#8364;&#x1F30A;": "\u20ac\U0001f30a", "&copy; &": "&copy; &"}
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["u"] for r in frame.select("t", links.unescape("t").alias("u")).collect()} == texts


def test_item_without_id_is_null(spark):
    (row,) = exploded(spark, _index(f'<ul class="histfiles"><li> \n <a href="{link(62107, 1991)}">1</a></li></ul>'))
    assert row["buoy_id"] is None
