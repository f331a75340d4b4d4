"""Reading HTML by its element tree, with column functions only.

One extraction cuts a page into comments, tags and texts; a fold over these tokens
keeps the stack of open elements. What the fold hands out are the items of marked
lists and the anchors that mark a section, each with the place of its parent, so
"a list beside the anchor" is a comparison of parents, whichever comes first.

Read as a browser would: names in any case, attributes in either quotes or none,
comments, scripts and declarations skipped, list items without an end tag, void elements,
end tags without a start. A narrow transformation: a page is one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Element names of HTML that the reading depends on.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Elements that end an open paragraph.
BLOCK = ("address", "blockquote", "center", "dir", "div", "dl", "fieldset", "form", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "menu", "ol", "p", "pre", "table", "ul")
#: Elements that an end tag of another kind doesn't reach beyond.
BOUNDS = ("ul", "ol", "li", "table", "td", "div", "body", "html")

_TOKEN = (
    r"(?is)(<!--.*?(?:-->|\z)|<script\b.*?(?:</script[^>]*>|\z)|<style\b.*?(?:</style[^>]*>|\z)|<[!?][^>]*>|"
    r"""</?[a-z](?:[^>"']|"[^"]*"|'[^']*')*+>|[^<]+|<)"""
)
_ELEMENT = "struct<pos:int,tag:string,parent:int,listed:boolean,label:string,hrefs:array<string>>"
_FOUND = "struct<kind:string,pos:int,parent:int,label:string,hrefs:array<string>>"


def _attribute(token: Column, name: str) -> Column:
    """Text of an attribute as it is written; NULL if the tag has none."""
    pattern = rf"""(?is)^<[a-z][^\s>/]*(?:[^>"']|"[^"]*"|'[^']*')*?[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    raw = F.regexp_extract(token, pattern, 1)
    return F.when(raw != "", F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2"))


def tokens(html: Column) -> Column:
    """Array of (kind, tag, id, class, href, text): ``start``, ``end``, ``empty`` (an element without
    content) or ``text``; what is none of these is left out."""
    found = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(1))

    def read(token: Column) -> Column:
        tag = F.lower(F.regexp_extract(token, r"(?i)^</?([a-z][^\s>/]*)", 1))
        is_text = ~token.startswith("<") | (token == "<")
        skipped = token.rlike(r"(?i)\A<(?:[!?]|script\b|style\b)")
        kind = (
            F.when(is_text, "text").when(skipped, "skip").when(token.startswith("</"), "end")
            .when(token.endswith("/>") | tag.isin(*VOID), "empty").otherwise("start")
        )
        named = (kind == "start") | (kind == "empty")
        return F.struct(
            kind.alias("kind"), tag.alias("tag"),
            F.when(named & (tag == "a"), _attribute(token, "id")).alias("id"),
            F.when(named & tag.isin("ul", "ol"), _attribute(token, "class")).alias("class"),
            F.when(named & (tag == "a"), _attribute(token, "href")).alias("href"),
            F.when(is_text, token).alias("text"),
        )

    return F.filter(F.transform(found, read), lambda t: t["kind"] != "skip")


def _items(popped: Column) -> Column:
    """Closed elements -> found items, innermost first."""
    return F.transform(F.filter(popped, lambda e: (e["tag"] == "li") & e["listed"]), lambda e: F.struct(F.lit("item").alias("kind"), e["pos"].alias("pos"), e["parent"].alias("parent"), e["label"].alias("label"), e["hrefs"].alias("hrefs")))


def _keep(stack: Column, n: Column) -> Column:
    return F.slice(stack, F.lit(1), n)


def _beyond(stack: Column, n: Column) -> Column:
    return F.slice(stack, n + 1, F.greatest(F.size(stack) - n, F.lit(0)))


def _last_where(stack: Column, of) -> Column:
    """Place (from 1) of the innermost element for which ``of`` holds; 0 if there is none."""
    return F.aggregate(F.transform(stack, lambda e, i: F.when(of(e), i + 1).otherwise(F.lit(0))), F.lit(0), lambda a, b: F.greatest(a, b))


def marked_items(html: Column, anchor_id: str, list_class: str) -> Column:
    """Array of (pos, label, hrefs): the items directly in a list of class ``list_class`` that has
    the same parent as an anchor named ``anchor_id``, in page order. ``label`` is the item's first
    text (NULL without one), ``hrefs`` the links directly in it; both as written."""
    none, nothing, nobody = F.lit(None).cast("string"), F.array().cast("array<string>"), F.array().cast(f"array<{_FOUND}>")

    def step(state: Column, token: Column) -> Column:
        """The frequent tokens first (text, the end of the innermost element, a link in an item): they
        change the top of the stack alone."""
        stack = state["stack"]
        top = F.when(F.size(stack) > 0, F.element_at(stack, -1))

        def passed_on(state: Column, change: Column) -> Column:
            found = F.when(F.size(change["added"]) > 0, F.concat(state["found"], change["added"])).otherwise(state["found"])
            return F.struct(change["stack"].alias("stack"), found.alias("found"), (state["n"] + 1).alias("n"))

        # an aggregate passes its state on, where a transform would copy all that was found before
        return F.aggregate(F.array(_let(top, lambda top: quick(state, token, top))), state, passed_on)

    def quick(state: Column, token: Column, top: Column) -> Column:
        stack, tag, kind = state["stack"], token["tag"], token["kind"]
        below = _keep(stack, F.size(stack) - 1)
        item = F.coalesce(top["listed"] & (top["tag"] == "li"), F.lit(False))

        def with_top(label: Column, hrefs: Column, *more: Column) -> Column:
            fed = F.struct(top["pos"].alias("pos"), top["tag"].alias("tag"), top["parent"].alias("parent"), top["listed"].alias("listed"), label.alias("label"), hrefs.alias("hrefs"))
            return F.concat(below, F.array(fed, *more))

        def state_of(stack: Column) -> Column:
            return F.struct(stack.cast(f"array<{_ELEMENT}>").alias("stack"), nobody.alias("added"))

        link = F.struct((state["n"] + 1).alias("pos"), F.lit("a").alias("tag"), top["pos"].alias("parent"), F.lit(False).alias("listed"), none.alias("label"), nothing.alias("hrefs"))
        linked = with_top(top["label"], F.concat(top["hrefs"], F.array(token["href"])), link)
        return (
            F.when((kind == "text") & item & top["label"].isNull(), state_of(with_top(token["text"], top["hrefs"])))
            .when(kind == "text", state_of(stack))
            .when((kind == "end") & (top["tag"] == tag) & (tag != "li"), state_of(below))
            .when((kind == "start") & (tag == "a") & item & token["id"].isNull() & token["href"].isNotNull(), state_of(linked))
            .otherwise(full(state, token))
        )

    def full(state: Column, token: Column) -> Column:
        stack, tag, kind = state["stack"], token["tag"], token["kind"]
        opens = (kind == "start") | (kind == "empty")

        def stay(at: Column) -> Column:
            """How many open elements stay before the token takes effect."""
            depth = F.size(stack)
            ends = (
                F.when((tag == "li") & (at["match"] < at["list"]), depth)  # an item's end tag doesn't leave its list
                .when((at["match"] > 0) & (tag.isin(*BOUNDS) | (at["match"] > at["bound"])), at["match"] - 1)
                .otherwise(depth)
            )
            starts = (
                F.when((tag == "li") & (at["item"] > at["list"]), at["item"] - 1)
                .when(((tag == "a") & (at["innermost"] == "a")) | (tag.isin(*BLOCK) & (at["innermost"] == "p")), depth - 1)
                .otherwise(depth)
            )
            return F.when(kind == "end", ends).when(opens, starts).otherwise(depth)

        places = F.struct(
            _last_where(stack, lambda e: e["tag"] == "li").alias("item"),
            _last_where(stack, lambda e: e["tag"].isin("ul", "ol")).alias("list"),
            _last_where(stack, lambda e: e["tag"] == tag).alias("match"),
            _last_where(stack, lambda e: e["tag"].isin(*BOUNDS)).alias("bound"),
            F.when(F.size(stack) > 0, F.element_at(stack, -1)["tag"]).alias("innermost"),
        )

        def after(kept: Column) -> Column:
            inner = F.when(F.size(kept["stack"]) > 0, F.element_at(kept["stack"], -1))
            return _let(inner, lambda inner: entered(kept["stack"], kept["popped"], inner))

        def entered(kept: Column, popped: Column, inner: Column) -> Column:
            n, parent = state["n"] + 1, F.coalesce(inner["pos"], F.lit(0))
            is_list = opens & tag.isin("ul", "ol") & F.coalesce(token["class"] == list_class, F.lit(False))
            in_list = F.coalesce(inner["listed"] & inner["tag"].isin("ul", "ol"), F.lit(False))
            in_item = F.coalesce(inner["listed"] & (inner["tag"] == "li"), F.lit(False))
            # an item directly in hand takes its first text and its links
            label = F.when(kind == "text", F.coalesce(inner["label"], token["text"])).otherwise(inner["label"])
            hrefs = F.when(opens & token["href"].isNotNull(), F.concat(inner["hrefs"], F.array(token["href"]))).otherwise(inner["hrefs"])
            fed = F.struct(inner["pos"].alias("pos"), inner["tag"].alias("tag"), inner["parent"].alias("parent"), inner["listed"].alias("listed"), label.alias("label"), hrefs.alias("hrefs"))
            under = F.when(in_item & (kind != "end"), F.concat(_keep(kept, F.size(kept) - 1), F.array(fed))).otherwise(kept)
            listed = F.when(tag == "li", in_list).otherwise(is_list)
            new = F.struct(n.alias("pos"), tag.alias("tag"), parent.alias("parent"), listed.alias("listed"), none.alias("label"), nothing.alias("hrefs"))

            def entry(name: str) -> Column:
                return F.array(F.struct(F.lit(name).alias("kind"), n.alias("pos"), parent.alias("parent"), none.alias("label"), nothing.alias("hrefs")))

            marks = opens & (tag == "a") & F.coalesce(token["id"] == anchor_id, F.lit(False))
            added = F.concat(_items(popped), F.when(marks, entry("anchor")).when(is_list, entry("list")).otherwise(nobody))
            grown = F.when(kind == "start", F.concat(under, F.array(new))).otherwise(under)
            return F.struct(grown.cast(f"array<{_ELEMENT}>").alias("stack"), added.cast(f"array<{_FOUND}>").alias("added"))

        cut = lambda n: _let(F.struct(_keep(stack, n).alias("stack"), _beyond(stack, n).alias("popped")), after)
        return _let(places, lambda at: _let(stay(at), cut))

    start = F.struct(F.array().cast(f"array<{_ELEMENT}>").alias("stack"), F.array().cast(f"array<{_FOUND}>").alias("found"), F.lit(0).alias("n"))
    found = F.aggregate(tokens(html), start, step, lambda s: F.concat(s["found"], _items(s["stack"])))
    return _let(found, _beside_anchor)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _beside_anchor(found: Column) -> Column:
    parents = F.transform(F.filter(found, lambda e: e["kind"] == "anchor"), lambda e: e["parent"])
    lists = F.transform(F.filter(found, lambda e: (e["kind"] == "list") & F.array_contains(parents, e["parent"])), lambda e: e["pos"])
    items = F.filter(found, lambda e: (e["kind"] == "item") & F.array_contains(lists, e["parent"]))
    return F.array_sort(F.transform(items, lambda e: F.struct(e["pos"].alias("pos"), e["label"].alias("label"), e["hrefs"].alias("hrefs"))))
