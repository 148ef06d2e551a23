"""Pages as DOM columns, and selectors on them as column expressions.

A page becomes one struct: its text once, and its elements in document order,
each with the range of text and of elements it holds. Selectors are then filters
on the array within the row. Nothing is exploded or shuffled to extract a page.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import let

NODE = (
    "struct<pre:int,last:int,parent:int,depth:int,tag:string,attrs:map<string,string>,classes:array<string>,"
    "t0:int,t1:int,sib_index:int,sib_count:int,child_count:int,path:array<int>>"
)
DOM = f"struct<text:string,nodes:array<{NODE}>>"
# Fixed values of HTML: elements without content, and which open elements a new one closes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
BLOCKS = set("address article aside blockquote details div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
SCOPES = {"ul", "ol", "table", "div", "section", "article", "body", "td", "th", "dl", "select"}


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.size = 0
        self.nodes: list[dict] = []
        self.open: list[int] = []

    def _close_to(self, at: int) -> None:
        for i in self.open[at:]:
            self.nodes[i]["last"], self.nodes[i]["t1"] = len(self.nodes) - 1, self.size
        del self.open[at:]

    def _imply(self, tag: str) -> None:
        closing = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        for at in range(len(self.open) - 1, -1, -1):
            name = self.nodes[self.open[at]]["tag"]
            if name in closing:
                self._close_to(at)
                return
            if name in SCOPES and name not in closing:
                return

    def handle_starttag(self, tag, attrs):
        self._imply(tag)
        own = {k: v or "" for k, v in reversed(attrs)}
        node = {
            "pre": len(self.nodes), "last": len(self.nodes), "parent": self.open[-1] if self.open else -1, "depth": len(self.open), "tag": tag,
            "attrs": own, "classes": own.get("class", "").split(), "t0": self.size, "t1": self.size, "sib_index": 0, "sib_count": 0, "child_count": 0, "path": list(self.open),
        }
        self.nodes.append(node)
        if tag not in VOID:
            self.open.append(node["pre"])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[at]]["tag"] == tag:
                self._close_to(at)
                return

    def handle_data(self, data):
        if not (self.open and self.nodes[self.open[-1]]["tag"] in ("script", "style")):
            self.text.append(data)
            self.size += len(data)

    def done(self) -> dict:
        self._close_to(0)
        below: dict[int, list[int]] = {}
        for n in self.nodes:
            below.setdefault(n["parent"], []).append(n["pre"])
        for parent, pres in below.items():
            for i, pre in enumerate(pres):
                self.nodes[pre]["sib_index"], self.nodes[pre]["sib_count"] = i, len(pres)
            if parent >= 0:
                self.nodes[parent]["child_count"] = len(pres)
        return {"text": "".join(self.text), "nodes": self.nodes}


def build(html: str | None) -> dict | None:
    """The DOM of a page; null for a null or blank one. Broken markup never fails."""
    if html is None or not html.strip():
        return None
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.done()


def _doms(html: pd.Series) -> pd.DataFrame:
    built = [build(h) or {"text": None, "nodes": None} for h in html]
    return pd.DataFrame({"text": [b["text"] for b in built], "nodes": [b["nodes"] for b in built]})


def with_dom(pages: DataFrame, html: str = "html") -> DataFrame:
    """`pages` with a column dom in place of the HTML; blank pages have no nodes.

    Told to Spark as not deterministic, so that no filter parses pages a second time.
    """
    return pages.withColumn("dom", F.pandas_udf(_doms, DOM).asNondeterministic()(F.col(html))).drop(html)


# --- selectors ---------------------------------------------------------------

_PART = re.compile(r"^(?P<tag>[a-z][a-z0-9]*)?(?P<rest>(?:[.#][\w-]+|\[[\w-]+(?:\*?=(?:'[^']*'|\"[^\"]*\"))?\])*)$")


def matches(selector: str) -> Callable[[Column], Column]:
    """The predicate of a compound selector: tag, .class, #id, [attr], [attr='v'], [attr*='v']."""
    part = _PART.match(selector)
    if not part:
        raise ValueError(f"not a compound selector: {selector}")
    tests: list[Callable[[Column], Column]] = []
    if part["tag"]:
        tests.append(lambda n: n["tag"] == part["tag"])
    for piece in re.findall(r"[.#][\w-]+|\[[^\]]*\]", part["rest"]):
        if piece[0] == ".":
            tests.append(lambda n, v=piece[1:]: F.array_contains(n["classes"], v))
        elif piece[0] == "#":
            tests.append(lambda n, v=piece[1:]: attr(n, "id") == v)
        else:
            name, op, value = re.match(r"\[([\w-]+)(\*?=)?(.*)\]", piece).groups()
            value = value.strip("'\"")
            tests.append(lambda n, k=name, o=op, v=value: attr(n, k).isNotNull() if not o else attr(n, k).contains(v) if o == "*=" else attr(n, k) == v)

    def test(node: Column) -> Column:
        said = F.lit(True)
        for t in tests:
            said = said & F.coalesce(t(node), F.lit(False))
        return said

    return test


def attr(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def text(dom_: Column, node: Column) -> Column:
    """All text within a node, trimmed; null for no node."""
    return F.regexp_replace(F.substring(dom_["text"], node["t0"] + 1, node["t1"] - node["t0"]), r"\A\s+|(?<!\s)\s+\z", "")


def all_of(dom_: Column, selector: str, within: Column | None = None) -> Column:
    """Nodes that match, in document order; only descendants of `within` if given (none for a null one)."""
    test = matches(selector)
    if within is None:
        return F.coalesce(F.filter(dom_["nodes"], test), F.array().cast(f"array<{NODE}>"))
    below = let(within, lambda w: F.filter(F.slice(dom_["nodes"], w["pre"] + 2, w["last"] - w["pre"]), test))
    return F.coalesce(below, F.array().cast(f"array<{NODE}>"))


def first_of(dom_: Column, *path: str) -> Column:
    """The first node of the last selector within the first node of the one before, and so on; null without one."""
    node = None
    for selector in path:
        node = F.get(all_of(dom_, selector, node), F.lit(0))
    return node


def first_text(dom_: Column, *path: str) -> Column:
    """The text of `first_of`; null if it is empty."""
    return let(first_of(dom_, *path), lambda n: F.nullif(text(dom_, n), F.lit("")))


def first_attr(dom_: Column, name: str, *path: str) -> Column:
    return F.nullif(attr(first_of(dom_, *path), name), F.lit(""))


def node_table(pages: DataFrame, key: str) -> DataFrame:
    """One row per element with its ancestors' range, for queries over elements: (key, node fields, text)."""
    slices = F.transform("dom.nodes", lambda n: F.struct(n.dropFields("path").alias("n"), text(F.col("dom"), n).alias("text")))
    # Only its own text goes with an element, not the page's.
    return pages.select(key, F.explode(slices).alias("e")).select(key, "e.n.*", "e.text")
