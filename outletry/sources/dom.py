"""HTML to rows: one for every element, numbered so that ancestry is a comparison.

Element e is inside a when a.pre < e.pre and e.post <= a.post, so each extractor is
relational. What tables ask for is told by the parser in its one pass: an element's
innermost row, that row's table, whether a table holds tables, and the first link
inside. The parser closes what HTML lets authors leave open (p, li, table cells
and rows, options, definition terms).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "page_id long, pre int, post int, depth int, parent int, tag string, id string, classes array<string>, href string, src string, type string, text string, lines string, row int, table int, is_wrapper boolean, link int"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {
    "li": ({"li"}, {"ul", "ol"}), "p": ({"p"}, {"td", "div", "li", "section", "article"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "tr", "td", "th"}, {"table"}),
}
_BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []
        self.pieces: list[tuple[int, str]] = []  # (element, text), in order

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _CLOSES:
            self._imply(*_CLOSES[tag])
        elif tag in _BLOCKS:
            self._imply({"p"}, {"td", "th", "div", "li", "section", "article", "body"})
        a = {k: v or "" for k, v in reversed(attrs)}
        k = len(self.rows)
        self.rows.append({"tag": tag, "attrs": a, "parent": self.open[-1] if self.open else -1, "depth": len(self.open), "post": k})
        if tag not in _VOID:
            self.open.append(k)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[at]]["tag"] == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        if self.open:
            self.pieces.append((self.open[-1], data))

    def _imply(self, closes: set[str], within: set[str]) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            tag = self.rows[self.open[at]]["tag"]
            if tag in within:
                break
            if tag in closes:
                self._close(at)

    def _close(self, at: int) -> None:
        last = len(self.rows) - 1
        for k in self.open[at:]:
            self.rows[k]["post"] = last
        del self.open[at:]

    def done(self) -> list[dict]:
        self.close()
        self._close(0)
        texts: list[list[str]] = [[] for _ in self.rows]
        for k, data in self.pieces:
            if piece := " ".join(data.split()):
                while k >= 0:
                    texts[k].append(piece)
                    k = self.rows[k]["parent"]
        for k, r in enumerate(self.rows):
            r["text"], r["lines"] = " ".join(texts[k]), "\n".join(texts[k])
            r["link"], r["is_wrapper"] = None, False
            up = self.rows[r["parent"]] if r["parent"] >= 0 else {"tag": "", "in_row": None, "in_table": None, "table": None}
            # Where its children are: innermost row and table.
            r["row"], r["around"] = up["in_row"], up["in_table"]
            r["in_row"], r["in_table"] = k if r["tag"] == "tr" else up["in_row"], k if r["tag"] == "table" else up["in_table"]
            r["table"] = self.rows[r["row"]]["around"] if r["row"] is not None else None
            p = r["parent"]
            if r["tag"] == "a":
                while p >= 0 and self.rows[p]["link"] is None:  # those above an earlier link have theirs
                    self.rows[p]["link"] = k
                    p = self.rows[p]["parent"]
            elif r["tag"] == "table":
                t = r["around"]
                while t is not None and not self.rows[t]["is_wrapper"]:
                    self.rows[t]["is_wrapper"] = True
                    t = self.rows[t]["around"]
        return self.rows


def parse(html: str) -> list[dict]:
    """The elements of a page in document order."""
    tree = _Tree()
    tree.feed(html or "")
    return tree.done()


def elements(pages: DataFrame) -> DataFrame:
    """Pages (page_id, html) to their elements; a null or empty page has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for page, html in zip(batch["page_id"], batch["html"], strict=True):
                for pre, r in enumerate(parse(html)):
                    a = r["attrs"]
                    rows.append((page, pre, r["post"], r["depth"], r["parent"], r["tag"], a.get("id"), re.split(r"\s+", a["class"].strip()) if a.get("class") else [], a.get("href"), a.get("src"), a.get("type"), r["text"], r["lines"], r["row"], r["table"], r["is_wrapper"], r["link"]))
            yield pd.DataFrame(rows, columns=names)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).mapInPandas(run, SCHEMA)


def inside(outer: DataFrame, inner: DataFrame, on: str = "page_id") -> DataFrame:
    """Pairs of an outer and an inner element of one page; columns are prefixed o_ and i_.

    An equi-join on the page with the ranges as its condition.
    """
    o = outer.select([F.col(c).alias(f"o_{c}") for c in outer.columns])
    i = inner.select([F.col(c).alias(f"i_{c}") for c in inner.columns])
    return o.join(i, (F.col(f"o_{on}") == F.col(f"i_{on}")) & (F.col("o_pre") < F.col("i_pre")) & (F.col("i_post") <= F.col("o_post")))


def cells(dom: DataFrame) -> DataFrame:
    """Table cells: page_id, table, row, col, text, lines, anchor, href, is_wrapper (their table holds tables)."""
    c = dom.where("tag in ('td', 'th') and table is not null").select("page_id", "pre", "row", "table", "text", "lines", "link")
    wide = dom.where("tag = 'table' and is_wrapper").select("page_id", F.col("pre").alias("table"), "is_wrapper")
    links = dom.where("tag = 'a'").select("page_id", F.col("pre").alias("link"), F.col("text").alias("anchor"), "href")
    c = c.join(wide, ["page_id", "table"], "left").join(links, ["page_id", "link"], "left").withColumn("is_wrapper", F.coalesce("is_wrapper", F.lit(False)))
    return c.withColumn("col", F.row_number().over(Window.partitionBy("page_id", "table", "row").orderBy("pre")) - 1).drop("pre", "link")
