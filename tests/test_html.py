"""The element-tree reading against a tree built by Python's own tag parser."""

from __future__ import annotations

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tidewater.functions import html as H
from tidewater.functions import links


class Tree(HTMLParser):
    """Elements with parents; the same few rules of open and closed as a browser's."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.n, self.open, self.found, self.text = 0, [], [], None
        self.root = {"tag": "", "id": 0, "parent": None, "kids": []}

    def top(self):
        return self.open[-1] if self.open else self.root

    def handle_starttag(self, tag, attrs, empty=False):
        if tag == "li":
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k]["tag"] in ("ul", "ol"):
                    break
                if self.open[k]["tag"] == "li":
                    del self.open[k:]
                    break
        elif self.open and ((tag == "a" and self.top()["tag"] == "a") or (tag in H.BLOCK and self.top()["tag"] == "p")):
            self.open.pop()
        self.n += 1
        node = {"tag": tag, "id": self.n, "parent": self.top(), "attrs": dict(attrs), "kids": []}
        self.top()["kids"].append(node)
        self.found.append(node)
        if not empty and tag not in H.VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, True)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k]["tag"] == tag:
                del self.open[k:]
                return
            if self.open[k]["tag"] in (("ul", "ol") if tag == "li" else () if tag in H.BOUNDS else H.BOUNDS):
                return

    def handle_data(self, data):
        self.top()["kids"].append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def plain_items(page):
    tree = Tree()
    tree.feed(page)
    tree.close()
    beside = {id(e["parent"]) for e in tree.found if e["tag"] == "a" and e["attrs"].get("id") == "stdmet"}
    lists = [e for e in tree.found if e["tag"] in ("ul", "ol") and e["attrs"].get("class") == "histfiles" and id(e["parent"]) in beside]
    items = [e for e in tree.found if e["tag"] == "li" and any(e["parent"] is x for x in lists)]
    return [([k["attrs"]["href"] for k in e["kids"] if isinstance(k, dict) and k["tag"] == "a" and "href" in k["attrs"]], any(isinstance(k, str) for k in e["kids"])) for e in items]


def items(spark, pages):
    frame = spark.createDataFrame(list(enumerate(pages)), "k int, html string")
    rows = frame.select("k", H.marked_items(F.col("html"), "stdmet", "histfiles").alias("items")).orderBy("k").collect()
    return [[([links_ for links_ in i.hrefs], i.label) for i in r["items"]] for r in rows]


CASES = [
    # (page, [(label, [hrefs])])
    ('<div><a id="stdmet">x</a><ul class="histfiles"><li>1: <a href="a">1</a> <a href="b">2</a></li></ul></div>', [("1: ", ["a", "b"])]),
    ("<DIV><A ID=stdmet>x</A><UL CLASS='histfiles'><LI>1: <A HREF=a>1</A></LI></UL></DIV>", [("1: ", ["a"])]),
    ('<div><!-- <a id="stdmet"></a><ul class="histfiles"><li>9: <a href="z">z</a></li></ul> --><p>none</p></div>', []),
    ('<div><a id="stdmet"></a><!--<ul class="histfiles"><li>9: <a href="z"></a></li></ul>--><h3>Years</h3><ul class="histfiles"><li>1: <a href="a"></a></ul></div>', [("1: ", ["a"])]),
    ('<div><ul class="histfiles"><li>0: <a href="before"></a></li></ul><a id="stdmet"></a></div>', [("0: ", ["before"])]),
    ('<div><a id="stdmet"></a><ul class="histfiles"><li>1: <a href="a"></a><li>2: <a href="b"></a><li>3: <b><a href="deep"></a></b></ul></div>', [("1: ", ["a"]), ("2: ", ["b"]), ("3: ", [])]),
    ('<div><a id="stdmet"></a></div><ul class="histfiles"><li>9: <a href="z"></a></li></ul>', []),
    ('<div><a id="stdmet"></a><div><ul class="histfiles"><li>9: <a href="z"></a></li></ul></div></div>', []),
    ('<div><a id="stdmet"></a><ul class="histfiles x"><li>9:</li></ul><ul class="histfiles"><li><b>bold</b> 7: <a title="a > b" href="q"></a><ul><li>5: <a href="inner"></a></li></ul><a href="last"></a></li></ul></div>', [(" 7: ", ["q", "last"])]),
    ('<script>var s = "<a id=stdmet>";</script><a id="stdmet"/><br><ul class="histfiles"><li>1<</li><li></li></ul>', [("1", []), (None, [])]),
    ('<div><p><a id="stdmet"></a><ul class="histfiles"><li>9: </li></ul></div>', []),
    ("", []),
    ("plain < text & no tags", []),
    ('<a id="stdmet"></a><ul class="histfiles"><li>open <a href="x">', [("open ", ["x"])]),
]


def test_known_pages(spark):
    found = items(spark, [p for p, _ in CASES])
    assert [[(label, hrefs) for hrefs, label in page] for page in found] == [want for _, want in CASES]


def test_random_pages_against_a_tag_parser(spark):
    r = random.Random(6)
    bits = ['<a id="stdmet">', "</a>", '<ul class="histfiles">', "</ul>", "<li>", "</li>", '<a href="h1">', "<A HREF='h2'>", "text", "<div>", "</div>", "<b>", "</b>", "<p>", "</p>", "<br>", "<!-- c -->", "<ul>", "<h2>", "</h2>", " 410: "] + ["<li>", '<a href="h3">', "</a>", "x: "] * 6
    pages = [r.choice(['<div><a id="stdmet"></a><ul class="histfiles">', "<div>"]) + "".join(r.choice(bits) for _ in range(r.randrange(40))) for _ in range(400)]
    found = items(spark, pages)
    assert [[(h, label is not None) for h, label in page] for page in found] == [plain_items(p) for p in pages]
    assert sum(map(len, found)) > 100


def test_null_page(spark):
    frame = spark.createDataFrame([(None,)], "html string")
    assert frame.select(H.marked_items(F.col("html"), "stdmet", "histfiles")).first()[0] is None


def test_a_large_page_in_one_row(spark):
    """A page of 300 stations and 3,600 links."""
    page = '<div><a id="stdmet"></a><ul class="histfiles">' + "".join(f'<li>{s}: ' + " ".join(f'<a href="/d?filename={s}h{y}.txt.gz">{y}</a>' for y in range(1990, 2002)) for s in range(300)) + "</ul></div>"
    frame = spark.createDataFrame([("https://x/", page)], "url string, html string")
    began = time.time()
    assert links.explode_archive_index(frame).count() == 300 * 12
    assert time.time() - began < 60
